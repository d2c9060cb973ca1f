"""Heads and tables of contents of regulations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DASH = "\\s*[-\u2013\u2014]\\s*"


def single_blanks(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\u2009]+", " "))


def section_head(head: Column, number: Column) -> Column:
    """(section_number, contents_number, subject) of a section's head, given the number its source states, if any.

    The stated number wins: where the head cites it, with any dash, blanks or 'Sec.', what follows is the subject; where the
    head cites another one, that is the section number and the stated one stands in the contents; a head without a citation
    is all subject. Without a stated number the head's own counts, and a head without one is the section number itself."""
    text = single_blanks(head)
    stated = F.regexp_replace(single_blanks(number), "^\u00a7{1,2}\\s*", "")
    sign = F.nullif(F.regexp_extract(text, "^(\u00a7{1,2})", 1), F.lit(""))
    rest = F.regexp_replace(F.regexp_replace(text, "^\u00a7{1,2}\\s*", ""), r"(?i)^(?:section|sec\.)\s+", "")
    # the head begins with the stated number if both agree with dashes and blanks made alike, and a break follows it
    alike = lambda c: F.lower(F.regexp_replace(c, DASH, "-"))
    begins = F.startswith(alike(rest), alike(stated)) & (stated != "")
    after = F.substring(F.regexp_replace(rest, DASH, "-"), F.length(F.regexp_replace(stated, DASH, "-")) + 1, F.length(rest))
    cited = begins & after.rlike("^(\\s|[-\u2013\u2014:]|$)")
    own_number = F.regexp_extract(text, f"^\u00a7{{1,2}}\\s*([^\\s]+(?:{DASH}[^\\s]+)?)", 1)
    own_subject = F.regexp_extract(text, f"^\u00a7{{1,2}}\\s*[^\\s]+(?:{DASH}[^\\s]+)?\\s*(.*)$", 1)
    plain = F.when(stated != "", F.concat(F.lit("\u00a7 "), stated)).otherwise(text)
    section = F.when(cited, F.concat(F.coalesce(sign, F.lit("\u00a7")), F.lit(" "), stated)).when(own_number != "", F.concat(sign, F.lit(" "), own_number)).otherwise(plain)
    contents = F.when(stated != "", stated).when(own_number != "", own_number).otherwise("")
    subject = F.when(cited, F.regexp_replace(after, "^\\s*[-\u2013\u2014:]?\\s*", "")).when(own_number != "", own_subject).when(stated != "", text).otherwise("")
    return F.struct(section.alias("section_number"), contents.alias("contents_number"), F.trim(subject).alias("subject"))


def part_number(label: Column, heading: Column) -> Column:
    """A part's number from its label ('Pt. 61', 'PART 61.', '61') or else from its heading ('PART 194\u2014Special ...')."""
    number = lambda c: F.nullif(F.regexp_extract(single_blanks(c), r"(?i)^(?:pt\.?|part)?\s*(\d+[a-z]?)\b", 1), F.lit(""))
    titled = F.nullif(F.regexp_extract(single_blanks(heading), r"(?i)^part\s+(\d+[a-z]?)\b", 1), F.lit(""))
    return F.coalesce(number(label), titled)


def anchor(section_number: Column) -> Column:
    """Where a section stands on its page: seqnum and its number without sign and blanks."""
    return F.concat(F.lit("seqnum"), F.regexp_replace(section_number, "[\u00a7\\s\u2009]", ""))


def contents(paragraphs: DataFrame) -> DataFrame:
    """The table of contents of what ``scan_regulation_xml`` reads: (part, place, depth, kind, number, title, target).

    Within a part: its sections, its subject groups with theirs, its subparts with their sections, groups and appendices,
    and its appendices. A section's title is its subject and its target an anchor; groups, subparts and appendices have
    their heads. ``place`` counts a part's entries from 1 (a window over one row an entry)."""
    from pyspark.sql import Window

    c = F.col
    # order: own sections, groups, subparts, appendices; within a subpart and a group alike
    units = paragraphs.groupBy("part", "subpart_place", "group_place", "kind", "unit_place").agg(*[F.first(k, ignorenulls=True).alias(k) for k in ("subpart", "subpart_head", "subject_group", "section", "head")])
    parsed = section_head(c("head"), c("section"))
    missing, tail = F.lit(-1), c("kind") == "appendix"
    spot = F.array(
        F.when(c("subpart_place").isNotNull(), 2).when(c("group_place").isNotNull(), 1).when(tail, 3).otherwise(0), F.coalesce("subpart_place", missing),
        F.when(c("subpart_place").isNull(), missing).when(c("group_place").isNotNull(), 1).when(tail, 2).otherwise(0), F.coalesce("group_place", missing), F.when(c("group_place").isNull(), missing).otherwise(tail.cast("int")), c("unit_place"),
    )
    deep = c("subpart_place").isNotNull().cast("int") + c("group_place").isNotNull().cast("int") + 1
    own = units.select("part", spot.alias("spot"), deep.alias("depth"), "kind", F.when(tail, c("section")).otherwise(parsed["contents_number"]).alias("number"), F.when(tail, single_blanks(c("head"))).otherwise(parsed["subject"]).alias("title"), F.when(~tail, anchor(parsed["section_number"])).alias("target"))
    none = F.lit(None).cast("string")
    before = lambda n: F.concat(F.slice("spot", 1, n), F.array_repeat(F.lit(-2), 6 - n))
    placed = units.withColumn("spot", spot)
    subparts = placed.where("subpart_place is not null").select("part", before(2).alias("spot"), F.lit(1).alias("depth"), F.lit("subpart").alias("kind"), c("subpart").alias("number"), single_blanks(c("subpart_head")).alias("title"), none.alias("target")).distinct()
    groups = placed.where("group_place is not null").select("part", before(4).alias("spot"), (deep - 1).alias("depth"), F.lit("group").alias("kind"), none.alias("number"), single_blanks(c("subject_group")).alias("title"), none.alias("target")).distinct()
    place = F.row_number().over(Window.partitionBy("part").orderBy("spot"))
    return own.unionByName(subparts).unionByName(groups).select("part", place.alias("place"), "depth", "kind", "number", "title", "target")

"""Editions: dates as sources write them, effective intervals, groups that change less often, agreement of sources, printed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.columns import airac_start, major_start

# Abbreviations of months, forms of dates in sources, and the groups that change every 56 days.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
CODE, STAMP, DAY = r"^(\d{2})([A-Z]{3})(\d{4})$", r"^0901Z (\d{2})/(\d{2})/(\d{2})$", r"^\d{4}-\d{2}-\d{2}$"
PERIOD = r"(?i)Effective:?\s*\d{4}Z\s+(\d{1,2})\s+([A-Z]{3})\s+(\d{4})\s+to:?\s*\d{4}Z\s+(\d{1,2})\s+([A-Z]{3})\s+(\d{4})"
MAJOR_GROUPS = ("AWY", "PFR", "DP", "STAR")
PAGE = r"^[A-Z]{0,2}\d{1,4}$"


def calendar_day(year: Column, month: Column, day: Column) -> Column:
    """The date of three columns of digits; null if there is no such day."""
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def month_number(name: Column) -> Column:
    """01 to 12 of an abbreviation in any case; null for other words."""
    place = F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(name))
    return F.when(place > 0, place.cast("string"))


def when_all(*parts: Column) -> Column:
    """``calendar_day`` of year, month and day, null unless all of them are there (``concat_ws`` skips nulls)."""
    return F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), calendar_day(*parts))


def day_code(day: Column) -> Column:
    """ddMMMyyyy of a date, months in English whatever the session's locale."""
    return F.concat(F.lpad(F.dayofmonth(day).cast("string"), 2, "0"), F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day)), F.lpad(F.year(day).cast("string"), 4, "0"))


def day_of_code(code: Column) -> Column:
    """The date of ddMMMyyyy in capitals; null for all else."""
    piece = lambda k: F.regexp_extract(code, CODE, k)
    return F.when(code.rlike(CODE), when_all(piece(3), month_number(piece(2)), piece(1)))


def day_of_stamp(stamp: Column) -> Column:
    """The date of ``0901Z mm/dd/yy``, of this century; null for all else."""
    piece = lambda k: F.regexp_extract(stamp, STAMP, k)
    return F.when(stamp.rlike(STAMP), when_all(F.concat(F.lit("20"), piece(3)), piece(1), piece(2)))


def period_of_text(text: Column) -> Column:
    """(starts, ends) of the first effective period that a text names, words in any case; null if none is named or a day of it doesn't exist."""
    piece = lambda k: F.regexp_extract(text, PERIOD, k)
    starts, ends = when_all(piece(3), month_number(piece(2)), piece(1)), when_all(piece(6), month_number(piece(5)), piece(4))
    return F.when(text.rlike(PERIOD) & starts.isNotNull() & ends.isNotNull(), F.struct(starts.alias("starts"), ends.alias("ends")))


def period_reason(starts: Column, ends: Column) -> Column:
    """Why an effective period can't be used; null if it can."""
    return F.when(starts.isNull(), "unreadable-start").when(ends.isNull(), "unreadable-end").when(ends <= starts, "empty-interval")


def group_effective_day(cycle: Column, group: Column, major=MAJOR_GROUPS) -> Column:
    """The day from which a group's rows hold in an edition that begins on ``cycle``, a date or text: groups of ``major``
    keep the rows of the 56-day edition. Null where ``cycle`` is no day on which an edition begins; other and null groups change every time."""
    text = cycle.cast("string")
    day = F.when(text.rlike(DAY), F.try_to_date(text, "yyyy-MM-dd"))
    return F.when(airac_start(day) == day, F.when(group.isin(*major), major_start(day)).otherwise(day))


def edition_agreement(parts: DataFrame, index: DataFrame, key: str, revision: str) -> DataFrame:
    """Each part's (``starts``, ``ends``) against its ``revision`` day and the edition that ``index`` (one row a key) states.

    Adds ``state``: the reason if the period can't be used, ``does-not-cover`` unless starts <= revision < ends (a null
    revision is never covered), ``no-index`` without a row of the key, ``editions-differ`` unless both days are the same, else ``agrees``.
    Several rows of a key in ``index`` agree only with parts that agree with all of them; parts are never multiplied.
    """
    days = index.groupBy(F.col(key).alias("index_key")).agg(F.min("starts").alias("s0"), F.max("starts").alias("s1"), F.min("ends").alias("e0"), F.max("ends").alias("e1"), F.count_if(F.col("starts").isNull() | F.col("ends").isNull()).alias("unread"))
    rows = parts.join(days, parts[key] == days["index_key"], "left")
    covers = F.coalesce((F.col("starts") <= F.col(revision)) & (F.col(revision) < F.col("ends")), F.lit(False))
    same = (F.col("unread") == 0) & (F.col("s0") == F.col("starts")) & (F.col("s1") == F.col("starts")) & (F.col("e0") == F.col("ends")) & (F.col("e1") == F.col("ends"))
    state = F.coalesce(period_reason(F.col("starts"), F.col("ends")), F.when(~covers, "does-not-cover").when(F.col("index_key").isNull(), "no-index").when(F.coalesce(same, F.lit(False)), "agrees").otherwise("editions-differ"))
    return rows.select(*[parts[c] for c in parts.columns], state.alias("state"))


def cycles_with_manifest(folders: DataFrame, manifests: DataFrame, through: str | None = None) -> DataFrame:
    """(cycle, complete), newest first: the distinct names of ``folders`` that are days, none after ``through``; complete ones have a row in ``manifests``.

    Both have a column ``cycle`` of text; names that are no day of the calendar are other folders and stay out.
    """
    day = F.col("cycle").rlike(DAY) & F.try_to_date("cycle", "yyyy-MM-dd").isNotNull()
    names = folders.where(day if through is None else day & (F.col("cycle") <= through)).select("cycle").distinct()
    held = manifests.select("cycle").distinct().withColumn("held", F.lit(True))
    return names.join(held, "cycle", "left").select("cycle", F.coalesce("held", F.lit(False)).alias("complete")).orderBy(F.desc("cycle"))


def page_token(label: Column) -> Column:
    """A printed label in capitals without white space."""
    return F.upper(F.regexp_replace(label, r"\s+", ""))


def resolve_pages(targets: DataFrame, pages: DataFrame, volume: str = "volume", section: str = "section", printed: str = "printed", labels: str = "labels", page: str = "page") -> DataFrame:
    """Targets (``volume``, ``section``, ``printed``) with the ``page`` whose ``labels`` hold section and printed page, and a ``state``.

    A label counts if it is up to two letters and one to four digits; it resolves only if one page of the volume has it, however
    often that page repeats it. state is ``resolved``, ``ambiguous``, ``missing``, or ``no-page`` for a target without a printed page. Labels
    are counted before the join, so no target is multiplied; volumes of several books are not mixed. A null section counts as empty.
    """
    rows = pages.select(F.col(volume).alias("v"), F.col(page).alias("p"), F.explode(labels).alias("label")).select("v", "p", page_token(F.col("label")).alias("token")).where(F.col("token").rlike(PAGE))
    found = rows.groupBy("v", "token").agg(F.min("p").alias("first"), F.max("p").alias("last"))
    wanted = page_token(F.concat(F.coalesce(F.col(section).cast("string"), F.lit("")), F.col(printed).cast("string")))
    asked = targets.withColumn("wanted_token", F.when(F.length(printed) > 0, wanted))
    one = F.col("first") == F.col("last")
    state = F.when(F.col("wanted_token").isNull(), "no-page").when(F.col("first").isNull(), "missing").when(one, "resolved").otherwise("ambiguous")
    met = asked.join(found, (asked[volume] == found["v"]) & (asked["wanted_token"] == found["token"]), "left")
    return met.select(*[asked[c] for c in targets.columns], F.when(one, F.col("first")).alias(page), state.alias("state"))

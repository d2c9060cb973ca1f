"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, written

SMALL_TABLE = 100_000  # rows up to which the table of sources is broadcast
UNIT = float(1 << 52)
DIGITS, REACH = 8, 30  # preferences are told apart by 8 binary digits, from 2**-30 to 2**30: some 7,700 values at most


def source_key(source: Column) -> Column:
    """A join and sort key that keeps null apart from every text and after them all."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Adds ``target`` to a table of (key, source_size): shares of all words by weight, repeating over the keys in order.

    A target stops at ``most`` times its source's size, and the excess goes to the others by weight until none is above.
    This is water filling: in the order of size by weight, the sources below the level are full, and the first that is
    not sets the level. The windows run over one row for each source.
    """
    by_key = Window.orderBy("key")
    rank = F.row_number().over(by_key) - 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "key")
    all_rows = Window.partitionBy(F.lit(0))
    full = most * F.col("source_size")
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = weighed.withColumns({"left": left, "share": share, "place": F.row_number().over(order)})
    level = level.withColumn("open", full.cast("double") >= (F.col("weight") * F.col("left")).cast("double") / F.col("share"))
    at = F.min_by(F.struct("left", "share"), F.when(F.col("open"), F.col("place"))).over(all_rows)
    even = (F.col("weight") * F.col("at.left")).cast("double") / F.col("at.share")
    return level.withColumn("at", at).select("key", "source_size", F.least(full.cast("double"), even).alias("target"))


def with_sources(docs: DataFrame, sources: DataFrame) -> DataFrame:
    small = sources.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE
    return docs.join(F.broadcast(sources) if small else sources, "key")


def measured(docs: DataFrame, preference: Column | None, seed: str, row: Column | None = None) -> DataFrame:
    """(doc_id, key, size, class, digits) of each row, and ``row`` if given. ``preference`` is an expression over ``docs``
    and the column ``size`` of its words. Its first ``DIGITS`` binary digits count, those beyond ``REACH`` powers of two as
    the nearest within; null, NaN, 0 and less count as 0, and nothing else does."""
    sized = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), source_key(F.col("source")).alias("key"), F.explode(F.array(n_words(F.col("text")))).alias("size"))  # explode: else each use of size would count the words anew
    value = F.lit(1.0) if preference is None else F.nanvl(F.coalesce(preference.cast("double"), F.lit(0.0)), F.lit(0.0))
    within = F.least(F.lit(2.0**REACH), F.greatest(F.lit(2.0**-REACH), value))
    step = F.pow(F.lit(2.0), F.floor(F.log2(within)) - (DIGITS - 1))
    grade = F.when(value > 0, F.round(within / step) * step).otherwise(0.0)
    opened = sized if preference is None else sized.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in ("row", "id", "key", "size")], "row", "id", "key", "size")
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary")), 1, 13), 16, 10).cast("long")
    kept = ["row"] if row is not None else []
    return opened.select(F.col("id").alias("doc_id"), "key", "size", grade.alias("class"), digits.alias("digits"), *kept)


def expected_copies(sums: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """(key, class, source_size, target, copies, whole) from the words of each class of preference (key, class, words).

    Copies are in proportion to the preference, ``most`` at most, so that the words of all come to the floor of the
    source's target. The level is found by filling from the highest class on: the first class at which the words still
    wanted, spread over it and all lower ones by preference, ask for ``most`` copies or fewer sets it. The window runs
    over the classes of one source, a few thousand rows at most."""
    order = Window.partitionBy("key").orderBy(F.desc("class"))
    all_rows = Window.partitionBy("key")
    rows = sums.join(sources, "key").withColumn("goal", F.floor("target").cast("long"))
    full = F.coalesce(F.sum(most * F.col("words")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spread = F.sum(F.col("words") * F.col("class")).over(order.rowsBetween(0, Window.unboundedFollowing))
    level = F.when(spread > 0, (F.col("goal") - full).cast("double") / spread.cast("double"))
    rows = rows.withColumn("level", level)
    first = F.max_by("level", F.when(F.col("level") * F.col("class") <= most, F.col("class"))).over(all_rows)
    copies = F.when(F.col("words") > 0, F.when(F.col("first").isNull(), F.when(F.col("class") > 0, float(most)).otherwise(0.0)).otherwise(F.least(F.lit(float(most)), F.col("first") * F.col("class")))).otherwise(0.0)
    return rows.withColumn("first", first).withColumn("copies", copies).select("key", "class", "source_size", "target", "goal", "copies", F.floor("copies").cast("long").alias("whole"))


TUPLE = ("rank", "digits", "doc_id", "size")


def ranked(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Adds what the source and class of a row say, and its ``rank``: the odds of its random number by those of its inclusion; null where nothing of it is left to chance."""
    small = params.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE
    random = (F.col("digits").cast("double") + 0.5) / UNIT
    rest = F.col("copies") - F.col("whole").cast("double")
    odds = random / (1.0 - random) / (rest / (1.0 - rest))
    joined = rows.join(F.broadcast(params) if small else params, ["key", "class"])
    return joined.withColumn("rank", F.when((rest > 0) & (F.col("size") > 0), odds))


def last_taken(rows: DataFrame, bins: int) -> DataFrame:
    """(key, end, left, many): the rank, digits, id and size at which each source's sample ends, how many words its rows there still give, and how many rows these are.

    Ranks are binned and the bins summed, so that only one bin of a source is put in order, equal rows counted first."""
    bin_of = F.least(F.lit(bins - 1), F.floor(F.col("rank") / (1 + F.col("rank")) * bins))
    binned = rows.withColumn("bin", bin_of)
    sums = binned.groupBy("key", "bin").agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("size")).otherwise(0)).alias("words"), F.sum(F.col("whole") * F.col("size")).alias("certain"), F.first("goal").alias("goal"))
    each, along = Window.partitionBy("key"), Window.partitionBy("key").orderBy("bin")
    sums = sums.withColumns({"need": F.col("goal") - F.sum("certain").over(each), "until": F.sum("words").over(along)})
    ends = written(sums.where("bin is not null and until >= need").groupBy("key").agg(F.min("bin").alias("end_bin"), F.min_by(F.col("need") - (F.col("until") - F.col("words")), F.col("bin")).alias("want")), "mix-bins")
    near = with_sources(binned.where("bin is not null"), ends).where("bin = end_bin").groupBy("key", "want", *TUPLE).agg(F.count("*").alias("many"))
    order = Window.partitionBy("key").orderBy(*TUPLE)
    upto = F.sum(F.col("size") * F.col("many")).over(order)
    placed = near.withColumn("upto", upto).where("upto >= want")
    last = placed.groupBy("key").agg(F.min(F.struct(*TUPLE, "many", (F.col("want") - (F.col("upto") - F.col("size") * F.col("many"))).alias("left"))).alias("last"))
    return last.select("key", F.struct(*[F.col("last")[c].alias(c) for c in TUPLE]).alias("end"), F.col("last.left").alias("left"), F.col("last.many").alias("many"))


def parts(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds ``part``: the words of each row that chance takes, its first ones."""
    small = ends.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE
    joined = rows.join(F.broadcast(ends) if small else ends, "key", "left")
    own = F.struct(*TUPLE)
    share = F.when(F.col("left") >= F.col("size") * F.col("many"), F.col("size")).otherwise(F.expr("left div many"))
    part = F.when(F.col("rank").isNull(), 0).when(F.col("end").isNull() | (own < F.col("end")), F.col("size")).when(own == F.col("end"), share).otherwise(0)
    return joined.withColumn("part", part.cast("long"))


def thresholds(slim: DataFrame, weights: tuple[int, ...], most: int, bins: int) -> tuple[DataFrame, DataFrame]:
    """What decides every row: copies by source and class, and where each source's sample ends. Both are small tables."""
    sums = slim.groupBy("key", "class").agg(F.sum("size").alias("words"))
    sums = written(sums, "mix-sums")
    sources = targets(sums.groupBy("key").agg(F.sum("words").alias("source_size")), weights, most)
    params = written(expected_copies(sums, sources, most), "mix-copies")
    return params, written(last_taken(ranked(slim, params), bins), "mix-ends")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, preference: Column | None = None, seed: str = "", bins: int = 4096) -> DataFrame:
    """Copies of each document that bring every source's words to its target.

    The copies expected of a document are in proportion to ``preference`` (an expression over ``docs`` and ``size``; all
    alike where it is not given), ``most`` at most, and bring the source's words to its target. Their whole part is
    certain. For the rest p, documents are ranked by the odds of a uniform number, drawn from the id, divided by the
    odds p / (1 - p), and taken in that order until the source's words are met: a Pareto sample of unequal inclusion
    odds and of fixed size in words. The last one is taken in part (its first words, ``part``).

    The texts are read once, for a table of (doc_id, key, size, class, digits). No source is gathered or put in order:
    what is found is one threshold a source, which every row then compares itself with. Null texts and texts without
    words have size 0 and are never sampled. A null source is a source of its own, ordered last. Rows that share id
    and size share one rank: where the sample ends at them, they give equal parts of the words that are left, and the
    remainder (fewer words than such rows) is not taken. Returns doc_id, key, size, source_size, target, copies, whole,
    part and taken; other columns are ignored. An empty table gives an empty result."""
    slim = written(measured(docs, preference, seed), "mix-sizes")
    params, ends = thresholds(slim, weights, most, bins)
    found = parts(ranked(slim, params), ends)
    return found.select("doc_id", "key", "size", "source_size", "target", "copies", "whole", "part", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, preference: Column | None = None, seed: str = "", bins: int = 4096) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it; the last of a source whole or not at all.

    Rows without words weigh nothing in any mix and are dropped. Each row is decided where it stands, so rows that share
    an id are judged apart and no column name can clash; a null id or source counts as ``mix`` says. An empty table
    stays empty."""
    slim = written(measured(docs, preference, seed), "mix-sizes")
    params, ends = thresholds(slim, weights, most, bins)
    rows = parts(ranked(measured(docs, preference, seed, row=F.col("row")), params), ends)
    times = F.col("whole") + (2 * F.col("part") >= F.greatest("size", F.lit(1))).cast("long")
    taken = rows.where(F.col("size") > 0).select("row", times.alias("times")).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def by_length(size: str = "size") -> Column:
    """A preference for longer documents: 1, 2, 3 or 4, from 50, 200 and 1,000 words on."""
    c = F.col(size)
    return F.when(c < 50, 1).when(c < 200, 2).when(c < 1000, 3).otherwise(4)

"""Data quality: every check gives the offending rows, and every input row is kept or accounted for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def single_value(tables: dict[str, DataFrame], column: str) -> DataFrame:
    """Values of a column over all tables with the tables that hold each; more than one row is a violation."""
    out = None
    for name, df in tables.items():
        part = df.select(F.col(column).alias("value"), F.lit(name).alias("table")).distinct()
        out = part if out is None else out.unionByName(part)
    return out.groupBy("value").agg(F.array_join(F.array_sort(F.collect_list("table")), ",").alias("tables"))


def unexpected(df: DataFrame, expected: DataFrame, key: str, column: str) -> DataFrame:
    """Rows whose value differs from the one expected for their group."""
    return df.join(expected, key).where(~F.col(column).eqNullSafe(F.col("expected")))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def childless(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    return parent.join(child.select(F.col(child_key).alias(parent_key)), parent_key, "left_anti")


def with_reason(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Adds ``reason``: the first rule that a row breaks, else null. Rows with a null reason are exported, the others are the ledger."""
    return df.withColumn("reason", F.coalesce(*[F.when(test, F.lit(name)) for name, test in rules]))


def coverage(df: DataFrame, table: Column) -> DataFrame:
    """Source, exported and excluded rows of each table."""
    return df.groupBy(table.alias("table")).agg(F.count("*").alias("source"), F.count_if(F.col("reason").isNull()).alias("exported"), F.count_if(F.col("reason").isNotNull()).alias("excluded"))


def reconcile(source: DataFrame, nested: DataFrame, key: str, array: str) -> DataFrame:
    """Counts by key of flat rows and of nested elements that do not agree."""
    flat = source.groupBy(key).agg(F.count("*").alias("source"))
    deep = nested.groupBy(key).agg(F.sum(F.size(array)).cast("long").alias("exported"))
    both = flat.join(deep, key, "full_outer").na.fill(0, ["source", "exported"])
    return both.withColumn("agrees", F.col("source") == F.col("exported"))


def discontinuities(df: DataFrame, key: str, order: list[str], point: str, following: str) -> DataFrame:
    """Rows whose pointer differs from the point of the next row."""
    after = F.lead(point).over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("after", after).where(F.col("after").isNotNull() & (F.col(following) != F.col("after")))


def main_branch(df: DataFrame, key: str, branch: str, transition: Column) -> DataFrame:
    """Exactly one branch that is not a transition is the main one; otherwise the reason why there is none."""
    mains = df.groupBy(key).agg(F.count_distinct(F.when(~transition, F.col(branch))).alias("mains"), F.min(F.when(~transition, F.col(branch))).alias("only"), F.count_distinct(F.when(transition, F.col(branch))).alias("transitions"))
    return mains.select(key, F.when(F.col("mains") == 1, F.col("only")).alias("main"), "transitions", F.when(F.col("mains") == 0, "missing").when(F.col("mains") > 1, "multiple").alias("reason"))


def sequence_faults(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """(keys, sequence, n, reason): sequence numbers that are missing, not positive, or held by several rows of a key."""
    n = df.groupBy(*keys, sequence).agg(F.count("*").alias("n"))
    reason = F.when(F.col(sequence).isNull(), "missing").when(F.col(sequence) <= 0, "not positive").when(F.col("n") > 1, "repeated")
    return n.withColumn("reason", reason).where("reason is not null")


def region_faults(regions: DataFrame, key: str, title: str, bounds: str) -> DataFrame:
    """(key, reasons) of regions that cannot be used; ``bounds`` is an array of rectangles [west, south, east, north].

    no id, repeated id, no title, no bounds, and of any rectangle: incomplete (four finite numbers are needed), out of
    range (180 and 90 degrees), disordered (west before east and south before north). A repeated id is one row each time."""
    c = F.col
    plain = lambda x: F.trim(F.coalesce(c(x), F.lit(""))) == ""
    counted = regions.groupBy(key).agg(F.count("*").alias("same")).where("same > 1")
    rows = regions.join(counted, key, "left")
    whole = lambda b: F.coalesce((F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False))
    wide = lambda b: (b[0] < -180) | (b[2] > 180) | (b[1] < -90) | (b[3] > 90)
    rules = {
        "no id": plain(key), "repeated id": c("same").isNotNull(), "no title": plain(title), "no bounds": F.coalesce(F.size(bounds), F.lit(0)) <= 0,
        "incomplete": F.exists(bounds, lambda b: ~whole(b)), "out of range": F.exists(bounds, lambda b: whole(b) & wide(b)), "disordered": F.exists(bounds, lambda b: whole(b) & ((b[0] >= b[2]) | (b[1] >= b[3]))),
    }
    return rows.select(key, F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in rules.items()])).alias("reasons")).where(F.size("reasons") > 0)

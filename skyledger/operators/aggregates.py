"""Aggregations: filed histories, route pairs, statistics, pyramids, least squares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.columns import half_up


def filed_history(facts: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Uses, first and last sighting of each (origin, destination, route, engine) among facts of the given labels."""
    kept = facts.where(F.col("label").isin(*labels) & (F.col("uses") > 0)).withColumn("engine", F.coalesce("engine", F.lit("Unknown")))
    return kept.groupBy("origin", "destination", "route", "engine").agg(F.sum("uses").alias("uses"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))


def route_pairs(filed: DataFrame) -> DataFrame:
    """One row per (origin, destination): total uses and its routes, the most used first, each with its uses by engine."""
    routes = filed.groupBy("origin", "destination", "route").agg(F.sum("uses").alias("uses"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("engine", "uses")))).alias("engines"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("uses")).alias("rank"), "route", "uses")))
    engines = F.map_from_entries(F.collect_list(F.struct("route", "engines")))
    return routes.groupBy("origin", "destination").agg(F.sum("uses").alias("total"), ranked.alias("routes"), engines.alias("engines"))


def invalid_facts(facts: DataFrame, **rules: Column) -> DataFrame:
    """How many rows break each rule, in one pass before the aggregation."""
    return facts.agg(*[F.count_if(F.coalesce(test, F.lit(True))).alias(name) for name, test in rules.items()])


def distinct_records(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Each record once, and how often each repeated one was dropped."""
    counted = df.groupBy(*columns).count()
    return counted.select(*columns), counted.where("count > 1").select(*columns, (F.col("count") - 1).alias("dropped"))


def downsample_max(cells: DataFrame, value: str) -> DataFrame:
    return cells.groupBy((F.col("x") / 2).cast("int").alias("x"), (F.col("y") / 2).cast("int").alias("y")).agg(F.max(value).alias(value))


def downsample_average(cells: DataFrame, value: str) -> DataFrame:
    """Half-up mean of the four children, null where one is missing."""
    return cells.groupBy((F.col("x") / 2).cast("int").alias("x"), (F.col("y") / 2).cast("int").alias("y")).agg(F.when(F.count(value) == 4, half_up(F.sum(value) / 4)).alias(value))


def density_rollup(cells: DataFrame, value: str, rows: int) -> DataFrame:
    """Area-weighted mean of each two by two cells (x, y) of a Mercator map of ``rows`` rows; a missing cell counts 0."""
    edge = lambda y: F.tanh(F.pi() * (1 - 2 * y / rows))
    area = lambda y: edge(y) - edge(y + 1)
    parent = [F.floor(F.col(c) / 2).cast("int").alias(c) for c in ("x", "y")]
    summed = cells.groupBy(*parent).agg(F.sum(F.col(value) * area(F.col("y"))).alias(value))
    return summed.withColumn(value, F.col(value) / (2 * (area(F.col("y") * 2) + area(F.col("y") * 2 + 1))))


def least_squares(df: DataFrame, keys: list[str], x: str, y: str, z: str) -> DataFrame:
    """Slopes of z over x and y in each group by the normal equations; null where they are singular."""
    sums = df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{c}") for c in (x, y, z)], *[F.sum(F.col(a) * F.col(b)).alias(f"s{a}{b}") for a, b in ((x, x), (y, y), (x, y), (x, z), (y, z))])
    s = {c: F.col(f"s{c}") for c in (x, y, z, x + x, y + y, x + y, x + z, y + z)}
    n = F.col("n")
    a, b, c = s[x + x] - s[x] * s[x] / n, s[y + y] - s[y] * s[y] / n, s[x + y] - s[x] * s[y] / n
    p, q = s[x + z] - s[x] * s[z] / n, s[y + z] - s[y] * s[z] / n
    det = a * b - c * c
    return sums.select(*keys, "n", F.when(det > 1e-9, (p * b - q * c) / det).alias("slope_x"), F.when(det > 1e-9, (q * a - p * c) / det).alias("slope_y"))


def nearest_rank(df: DataFrame, value: str, shares: dict[str, float], bins: int = 4096) -> DataFrame:
    """Values at rank floor(n * share), counted from 0, exact and without a total order in one task.

    Values are counted in ``bins`` equal ranges; only the ranges in which a wanted rank lies are looked at further, and
    there equal values are counted first. Nulls are left out."""
    rows = df.where(F.col(value).isNotNull()).select(value)
    ends = rows.agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))  # one row
    span = F.greatest(F.col("high") - F.col("low"), F.lit(1e-300))
    binned = rows.crossJoin(F.broadcast(ends)).withColumn("bin", F.least(F.lit(bins - 1), F.floor((F.col(value).cast("double") - F.col("low")) / span * bins)))
    counts = binned.groupBy("bin").count().withColumn("upto", F.sum("count").over(Window.orderBy("bin"))).withColumn("n", F.sum("count").over(Window.partitionBy(F.lit(0))))
    wanted = counts.select("bin", (F.col("upto") - F.col("count")).alias("before"), "upto", "n", F.explode(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])).alias("name", "share"))
    held = wanted.withColumn("rank", F.floor(F.col("n") * F.col("share"))).where("rank >= before and rank < upto").select("bin", "name", (F.col("rank") - F.col("before")).alias("rank"))
    inside = binned.join(F.broadcast(held.select("bin").distinct()), "bin").groupBy("bin", value).count()
    running = inside.withColumn("upto", F.sum("count").over(Window.partitionBy("bin").orderBy(value)))
    found = running.join(F.broadcast(held), "bin").where("upto > rank").groupBy("name").agg(F.min(value).alias("v"))
    picked = found.agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in shares])
    return picked.crossJoin(rows.agg(F.max(value).alias("largest")))


def retained(df: DataFrame, product: str, edition: str, most: int, through: str) -> DataFrame:
    """Rows of each product's newest ``most`` editions up to ``through``; later ones are not yet in force and stay out.

    Editions are counted once each before they are ranked, so a product with many rows is ranked by its editions alone."""
    from pyspark.sql import Window

    known = df.where(F.col(edition) <= F.lit(through)).select(product, edition).distinct()
    place = F.row_number().over(Window.partitionBy(product).orderBy(F.desc(edition)))
    return df.join(known.withColumn("place", place).where(F.col("place") <= most).drop("place"), [product, edition], "left_semi")

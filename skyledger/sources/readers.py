"""Sources: delimited, fixed-width and XML publications with fixed required columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checked_header(df: DataFrame, required: list[str], name: str) -> DataFrame:
    """Trims the header and rejects empty, repeated and missing columns; further columns stay."""
    columns = [c.strip().lstrip("﻿") for c in df.columns]
    if any(not c or re.fullmatch(r"_c\d+", c) for c in columns) or len(set(columns)) < len(columns):
        raise ValueError(f"{name}: empty or repeated column in the header")
    if missing := [c for c in required if c not in columns]:
        raise ValueError(f"{name}: missing columns {missing}")
    return df.toDF(*columns)


def scan_csv(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Quoted CSV with doubled quotes and line breaks inside quotes; a ragged row fails the read."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    return checked_header(df, required, path)


def scan_obstacles(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Windows-1252 CSV of one record a line, so that files split; blank lines are skipped, and a record of which all
    fields are empty fails the read. The charset needs Spark's legacy switch, which must be on while rows are read: set
    ``spark.sql.legacy.javaCharsets`` for the session, else this turns it on and leaves it so."""
    if spark.conf.get("spark.sql.legacy.javaCharsets", "false") != "true":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = spark.read.option("header", True).option("encoding", "windows-1252").option("mode", "FAILFAST").option("quote", '"').option("escape", '"').csv(path)
    df = checked_header(df, required, path)
    held = F.exists(F.array(*[F.trim(F.coalesce(f"`{c}`", F.lit(""))) for c in df.columns]), lambda x: x != "")
    return df.where(F.when(held, True).otherwise(F.raise_error(F.lit(f"{path}: a record without any value")).cast("boolean")))


def fixed_fields(lines: DataFrame, layout: dict[str, tuple[int, int]]) -> DataFrame:
    """Trimmed fields at zero-based character ranges of ``value``."""
    return lines.select(*[F.trim(F.substring("value", a + 1, b - a)).alias(c) for c, (a, b) in layout.items()])


def scan_fixed_width(spark: SparkSession, path: str, layout: dict[str, tuple[int, int]], width: int = 132, section: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of the full width (and of ``section``), and all other lines with the reason: width or section. Every line
    that is not blank is in one of the two."""
    lines = spark.read.text(path).where(F.rtrim("value") != "")
    wanted = F.coalesce(section, F.lit(False)) if section is not None else F.lit(True)
    reason = F.when(F.length("value") != width, "width").when(~wanted, "section")
    marked = lines.withColumn("reason", reason)
    return fixed_fields(marked.where("reason is null"), layout), marked.where("reason is not null")


def header_cycle(spark: SparkSession, path: str, expected: str, at: tuple[int, int] = (35, 39)) -> DataFrame:
    """Header lines (HDR01) whose cycle is not the one expected, and a row without a value where a file has none: empty if all is right."""
    lines = spark.read.text(path).where(F.startswith("value", F.lit("HDR01")))
    cycle = lines.select(F.substring("value", at[0] + 1, at[1] - at[0]).alias("cycle"))
    none = cycle.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("cycle"))
    return cycle.where(F.col("cycle") != expected).unionByName(none)


# The fields of a catalog record.
RECORD = ("chartseq", "chart_code", "chart_name", "useraction", "pdf_name", "cn_flg", "cnsection", "cnpage", "bvsection", "bvpage", "procuid", "two_colored", "civil", "faanfd18", "copter", "amdtnum", "amdtdate")
CATALOG = """_ID string, city_name array<struct<_ID string, _volume string, airport_name array<struct<_ID string, _apt_ident string, _icao_ident string, _military string, record array<map<string,string>>>>>>"""


def scan_catalog_xml(spark: SparkSession, path: str) -> DataFrame:
    """State, city, airport and record of a chart catalog, one row a record; ``extra`` holds the fields of a record that are not known ones."""
    states = spark.read.format("xml").option("rowTag", "state_code").schema(CATALOG).load(path)
    cities = states.select(F.col("_ID").alias("state"), F.explode("city_name").alias("c"))
    airports = cities.select("state", F.col("c._ID").alias("city"), F.col("c._volume").alias("volume"), F.explode("c.airport_name").alias("a"))
    rows = airports.select("state", "city", "volume", F.col("a._ID").alias("airport"), F.col("a._apt_ident").alias("ident"), F.col("a._icao_ident").alias("icao"), F.col("a._military").alias("military"), F.explode("a.record").alias("r"))
    extra = F.transform_values(F.map_filter("r", lambda k, v: ~k.isin(*RECORD)), lambda k, v: F.trim(F.coalesce(v, F.lit(""))))
    return rows.select("*", *[F.col("r")[f].alias(f) for f in RECORD], extra.alias("extra")).drop("r")


def scan_supplement_xml(spark: SparkSession, path: str) -> DataFrame:
    """Airports of a supplement that have an id, with volume, page and date from the file name."""
    schema = "_state string, airport array<struct<aptid string, aptname string, aptcity string, pdf string>>"
    rows = spark.read.format("xml").option("rowTag", "location").schema(schema).load(path).select(F.col("_state").alias("state"), F.explode("airport").alias("a")).select("state", "a.*")
    part = lambda k: F.regexp_extract("pdf", r"(?i)^([A-Z]+)_(\d+)_(\d{2}[A-Z]{3}\d{4})\.pdf$", k)
    named = rows.where(F.trim("aptid") != "").select("*", part(1).alias("volume"), part(2).try_cast("int").alias("page"), F.try_to_date(F.initcap(part(3)), "ddMMMyyyy").alias("edition"))
    return named.dropDuplicates(["aptid", "pdf"])


def scan_regulation_xml(spark: SparkSession, path: str, parts: list[str] | None = None, volume: str | None = None) -> DataFrame:
    """Paragraphs of a regulation: part, subpart, subject group, kind (section or appendix), section, head and text.

    A file is one document with one root and each part in it one splittable record; sections and appendices stand in a part, a subpart, or a subject group of either.
    ``section`` is the number that the source states, of an appendix its name. A unit without paragraphs keeps one row with
    a null text, so none is lost. ``subpart_place``, ``group_place``, ``unit_place`` and ``ord`` hold the places within what
    is around. ``volume`` keeps the parts of one volume."""
    unit = "array<struct<_N string, HEAD string, P array<string>>>"
    group = f"array<struct<_N string, HEAD string, DIV8 {unit}, DIV9 {unit}>>"
    inner = f"DIV7 {group}, DIV8 {unit}, DIV9 {unit}"
    rows = spark.read.format("xml").option("rowTag", "DIV5").schema(f"_N string, _VOLUME string, HEAD string, DIV6 array<struct<_N string, HEAD string, {inner}>>, {inner}").load(path)
    if parts is not None:
        rows = rows.where(F.col("_N").isin(*parts))
    if volume is not None:
        rows = rows.where(F.col("_VOLUME") == volume)
    c, text, number = F.col, F.lit(None).cast("string"), F.lit(None).cast("int")
    kinds = {"section": "DIV8", "appendix": "DIV9"}
    top = rows.select(c("_N").alias("part"), text.alias("subpart"), text.alias("subpart_head"), number.alias("subpart_place"), "DIV7", "DIV8", "DIV9")
    below = rows.select(c("_N").alias("part"), F.posexplode("DIV6").alias("at", "d")).select("part", c("d._N").alias("subpart"), F.trim("d.HEAD").alias("subpart_head"), c("at").alias("subpart_place"), "d.DIV7", "d.DIV8", "d.DIV9")
    level = top.unionByName(below)
    held = ["part", "subpart", "subpart_head", "subpart_place"]
    own = level.select(*held, text.alias("subject_group"), number.alias("group_place"), *kinds.values())
    grouped = level.select(*held, F.posexplode("DIV7").alias("group_place", "g")).select(*held, F.trim("g.HEAD").alias("subject_group"), "group_place", "g.DIV8", "g.DIV9")
    both = own.unionByName(grouped)
    held += ["subject_group", "group_place"]
    found = None
    for kind, tag in kinds.items():
        units = both.select(*held, F.lit(kind).alias("kind"), F.posexplode(tag).alias("unit_place", "s")).select(*held, "kind", "unit_place", c("s._N").alias("section"), c("s.HEAD").alias("head"), F.posexplode_outer("s.P").alias("ord", "text"))
        found = units if found is None else found.unionByName(units)
    return found.withColumn("text", F.trim(F.regexp_replace("text", "<[^>]+>", "")))


def scan_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_history(spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    """Aggregated facts from Parquet, or from a database by Spark's JDBC options."""
    return spark.read.format("jdbc").options(**jdbc).load() if jdbc else spark.read.parquet(path)


def overlaps(west: Column, south: Column, east: Column, north: Column, bounds: tuple[float, float, float, float], strict: bool = False) -> Column:
    """Rectangles that touch the bounds; with ``strict`` they must share area."""
    w, s, e, n = bounds
    return (west < e) & (east > w) & (south < n) & (north > s) if strict else (west <= e) & (east >= w) & (south <= n) & (north >= s)


def prune_partitions(spark: SparkSession, catalog: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Reads only the files whose footprint in ``catalog`` (path, west, south, east, north) touches the bounds; where none does, no row but the columns."""
    kept = catalog.where(overlaps(*map(F.col, ("west", "south", "east", "north")), bounds)).select("path").distinct().orderBy("path")
    paths = [r["path"] for r in kept.toLocalIterator()]
    if paths:
        return spark.read.parquet(*paths)
    first = catalog.select("path").orderBy("path").limit(1).collect()
    if not first:
        raise ValueError("the catalog names no file, so no schema is known")
    return spark.read.parquet(first[0]["path"]).where(F.lit(False))


def listing_products(objects: DataFrame, pattern: str, sidecar: str) -> tuple[DataFrame, DataFrame]:
    """Rasters paired with their sidecar file by stem, and violations: rasters without one and keys listed twice."""
    stems = objects.select("key", F.regexp_extract("key", pattern, 1).alias("stem")).where("stem <> ''")
    counted = stems.groupBy("key", "stem").count()
    rasters, sides = counted.where(~F.col("key").endswith(sidecar)), counted.where(F.col("key").endswith(sidecar)).select("stem", F.col("key").alias("side"))
    joined = rasters.join(sides, "stem", "left")
    bad = joined.where("side is null").select("key", F.lit("no sidecar").alias("reason")).unionByName(counted.where("count > 1").select("key", F.lit("repeated").alias("reason")))
    return joined.where("side is not null and count = 1").select("key", "stem", "side"), bad


def tile_bounds(key: Column, pattern: str, halo: float) -> Column:
    """Bounds of a degree tile named by its north-western corner, such as n41w073, widened by ``halo``; null where the name is none or off the map.

    ``pattern`` finds n or s, two digits, e or w, three digits in ``key``, each as a group."""
    part = lambda k: F.regexp_extract(key, pattern, k)
    north = part(2).try_cast("int") * F.when(part(1) == "n", 1).otherwise(-1)
    west = part(4).try_cast("int") * F.when(part(3) == "e", 1).otherwise(-1)
    usable = (north > -90) & (north <= 90) & (west >= -180) & (west < 180)
    return F.when(usable, F.struct((west - halo).alias("west"), (north - 1 - halo).alias("south"), (west + 1 + halo).alias("east"), (north + halo).alias("north")))


def products_in_regions(objects: DataFrame, regions: DataFrame, pattern: str, halo: float) -> tuple[DataFrame, DataFrame]:
    """Listed products (key) whose tile overlaps a region (west, south, east, north), with their bounds, each once; and keys that name no tile."""
    from skyledger.operators.joins import bbox_join

    named = objects.select("key").distinct().withColumn("tile", tile_bounds(F.col("key"), pattern, halo))
    bounds = named.where("tile is not null").select("key", "tile.*")
    edges = ("west", "south", "east", "north")
    found = bbox_join(bounds, regions.select(*edges), 4.0).select("key", *edges).distinct()
    return found, named.where("tile is null").select("key")

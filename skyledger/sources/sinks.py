"""Sinks: features as text, bounded batches, incremental generations published by one final rename."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def to_geojson(df: DataFrame, key: str, lon: str, lat: str, properties: list[str]) -> DataFrame:
    """One GeoJSON point feature a row as ``value``; null properties are left out. Write with ``.write.text(..., compression='gzip')``."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.col(key).alias("id"), point.alias("geometry"), F.struct(*properties).alias("properties"))
    return df.select(F.to_json(feature).alias("value"))


def size_batches(df: DataFrame, key: str, order: list[str], size: str, most: int) -> DataFrame:
    """Adds ``batch``: rows of a key in order, cut where the running size passes a multiple of ``most``.

    A greedy packer starts anew where a row would overflow; this form has the same bound up to one row and needs no
    sequential fold."""
    running = F.sum(size).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("batch", F.floor((running - F.col(size)) / most))


def misses(new: DataFrame, old: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """Rows whose fingerprint of ``content`` the last generation does not have; the rest may be reused."""
    mark = F.sha2(F.concat_ws("\n", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in content]), 256)
    return new.withColumn("mark", mark).join(old.withColumn("mark", mark).select(*keys, "mark"), [*keys, "mark"], "left_anti").drop("mark")


def publish(df: DataFrame, root: str, name: str) -> str:
    """Writes ``df`` under a folder named by its content, then moves a new manifest into place, which alone commits.

    The fingerprint adds row hashes, so it does not depend on order or partitions. A run that stops before the rename
    leaves the last manifest valid."""
    spark = df.sparkSession
    mark = df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0)).alias("x"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    content = f"{mark['n']:x}-{mark['x'] & (1 << 64) - 1:016x}-{int(mark['s']) & (1 << 64) - 1:016x}"
    path, fs = hadoop(spark, f"{root}/{name}/gen={content}")
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/gen={content}/_SUCCESS")):
        df.write.mode("overwrite").parquet(f"{root}/{name}/gen={content}")
    text = json.dumps({"name": name, "generation": content, "rows": mark["n"]})
    move_into_place(spark, text, f"{root}/{name}/.manifest-{content}", f"{root}/{name}/manifest.json")
    return content


def move_into_place(spark: SparkSession, text: str, draft: str, place: str) -> None:
    """Writes ``text`` to the file ``draft`` and renames it to ``place``, over what is there, in one step."""
    draft_path, fs = hadoop(spark, draft)
    out = fs.create(draft_path, True)
    out.write(bytearray(text.encode()))
    out.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    files.rename(draft_path, hadoop(spark, place)[0], how)


def hadoop(spark: SparkSession, path: str):
    """Hadoop path and its file system, so that any store Spark reads can be published to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed generation."""
    manifest = json.loads("".join(r["value"] for r in spark.read.text(f"{root}/{name}/manifest.json").collect()))
    return spark.read.parquet(f"{root}/{name}/gen={manifest['generation']}")


def prunable(files: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """Files outside the keep set; raises where a file to keep is missing."""
    gone = keep.join(files, key, "left_anti")
    if not gone.isEmpty():
        raise ValueError("the keep set names files that do not exist")
    return files.join(keep, key, "left_anti")

"""Tables kept in parts of bounded size, of which a new generation rewrites only those that change."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.functions.storage import forget, written

from .sinks import hadoop, move_into_place

ROW = ("kind", "z")


def fingerprint(content: list[str]) -> Column:
    """SHA-256 of a row's columns as text, nulls told from empty values."""
    return F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)


def bounded_parts(rows: DataFrame, keys: list[str], order: list[str], size: Column, most_bytes: int, most_rows: int) -> DataFrame:
    """Adds ``part``: rows of a key (no nulls) in order, at most ``most_rows`` and ``most_bytes`` a part; a larger row is a part of its own.

    Rows are put in order by ranges over many tasks, whatever a key holds. Running sums of a slice start at the sums of
    the slices before; a part ends where they pass a step. The step in bytes is half the bound and rows over half of it
    stand alone, so that a row that reaches over a step's end still fits: parts may be half full, never over full."""
    half, c = max(most_bytes // 2, 1), F.col
    sized = rows.withColumns({"_size": F.coalesce(size.cast("long"), F.lit(0)), "_big": F.coalesce(size, F.lit(0)) > half})
    sliced = written(sized.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()), "sliced")
    small = F.when(c("_big"), 0).otherwise(c("_size"))
    one = F.when(c("_big"), 0).otherwise(1)
    ahead = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*keys, "_slice").agg(F.sum(small).alias("b"), F.sum(one).alias("n"), F.sum(1 - one).alias("g"))
    before = sums.select(*keys, "_slice", *[F.coalesce(F.sum(k).over(ahead), F.lit(0)).alias(f"_{k}") for k in ("b", "n", "g")])
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    upto = lambda v: F.coalesce(F.sum(v).over(within), F.lit(0))
    placed = sliced.withColumns({"_ib": upto(small), "_in": upto(one), "_ig": upto(1 - one)}).join(before, [*keys, "_slice"])
    steps = (F.floor((c("_b") + c("_ib")) / half), F.floor((c("_n") + c("_in")) / most_rows))
    part = F.when(c("_big"), F.concat(F.lit("g"), c("_g") + c("_ig"))).otherwise(F.concat_ws("-", *[s.cast("string") for s in steps]))
    out = placed.withColumn("part", part).drop("_size", "_big", "_slice", "_b", "_n", "_g", "_ib", "_in", "_ig")
    out.sliced = sliced  # to be forgotten once ``out`` is written
    return out


def manifest_of(spark: SparkSession, root: str, name: str) -> dict | None:
    """The committed manifest, or None before the first generation."""
    try:
        return json.loads("".join(r["value"] for r in spark.read.text(f"{root}/{name}/manifest.json").collect()))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def commit(spark: SparkSession, root: str, name: str, manifest: dict) -> None:
    """Puts a manifest into place by one rename, which alone makes a generation current."""
    move_into_place(spark, json.dumps({"name": name, **manifest}), f"{root}/{name}/.manifest-{uuid.uuid4().hex}", f"{root}/{name}/manifest.json")


def rows_of(spark: SparkSession, root: str, name: str, manifest: dict) -> DataFrame:
    """A generation's rows with ``gen`` and ``part``: those of the parts its list names."""
    parts = spark.read.parquet(f"{root}/{name}/parts/{manifest['parts']}").select("gen", *ROW, "part")
    return spark.read.parquet(f"{root}/{name}/rows").join(parts, ["gen", *ROW, "part"], "left_semi")


def current_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed rows with their kind and zoom level ``z``."""
    return rows_of(spark, root, name, manifest_of(spark, root, name)).drop("gen", "part", "mark")


def publish_parts(rows: DataFrame, root: str, name: str, key: list[str], order: list[str], content: list[str], size: Column, most_bytes: int, most_rows: int) -> dict:
    """Publishes ``rows`` (kind, z, ``key``, ``content``) as a generation that keeps the parts of the last one that still hold.

    A row is reused if the last generation has its kind, z and key with the same fingerprint of ``content``. A part all
    of whose rows are reused stays as it is; rows of other parts are written anew with those that are new, in parts of
    bounded size. A part is the rows that share its name, which lie together in one file, many parts to a file: files are as
    many as tasks, however small the parts. The generation is a list of parts; one rename of the manifest commits it, and a run that stops before
    leaves the last generation whole. Keys are unique within kind and z; a repeated one fails, and so does a null. Returns counts: rows,
    reused_rows (in kept parts), written_rows, parts."""
    spark, gen = rows.sparkSession, f"g{uuid.uuid4().hex}"
    new = written(rows.withColumn("kind", F.col("kind").cast("string")).withColumn("z", F.col("z").cast("int")).withColumn("mark", fingerprint(content)), "new")
    if not new.groupBy(*ROW, *key).count().where(" or ".join(["count > 1", *[f"`{k}` is null" for k in (*ROW, *key)]])).isEmpty():
        raise ValueError(f"{name}: repeated or null keys")
    last = manifest_of(spark, root, name)
    keep = None
    if last:
        old = rows_of(spark, root, name, last).select("gen", *ROW, "part", *key, "mark")
        alive = old.join(new.select(*ROW, *key, "mark", F.lit(1).alias("alive")), [*ROW, *key, "mark"], "left")
        whole = alive.groupBy("gen", *ROW, "part").agg(F.count("*").alias("rows"), F.count("alive").alias("held")).where("rows = held").drop("held")
        keep = written(whole.join(spark.read.parquet(f"{root}/{name}/parts/{last['parts']}").drop("rows"), ["gen", *ROW, "part"]), "kept")
        fresh = new.join(old.join(keep, ["gen", *ROW, "part"], "left_semi").select(*ROW, *key), [*ROW, *key], "left_anti")
    else:
        fresh = new
    placed = bounded_parts(fresh, list(ROW), order, size, most_bytes, most_rows)
    cut = written(placed.withColumn("gen", F.lit(gen)), "cut")
    forget(placed.sliced)
    total = cut.count()
    # rows of a part go to one task and so into one file, next to each other
    cut.repartition(*ROW, "part").sortWithinPartitions(*ROW, "part", *order).write.partitionBy("gen").mode("append").parquet(f"{root}/{name}/rows")
    parts = cut.groupBy("gen", *ROW, "part").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    if keep is not None:
        parts = parts.unionByName(keep.select(parts.columns))
    parts.write.parquet(f"{root}/{name}/parts/{gen}")
    listed = spark.read.parquet(f"{root}/{name}/parts/{gen}").agg(F.count("*").alias("parts"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    found = {"rows": listed["rows"], "reused_rows": listed["rows"] - total, "written_rows": total, "n_parts": listed["parts"]}
    commit(spark, root, name, {"parts": gen, **found})
    forget(new, cut, *([keep] if keep is not None else []))
    return found


# Feeds


def upsert_batch(batch: DataFrame, batch_id: int, root: str, name: str, key: list[str], order: list[str], buckets: int = 64) -> bool:
    """Brings a micro-batch into the table ``name``: the newest row of each key counts. False if the batch was in already.

    Rows are newer by the columns ``order``, of equals by fingerprint. A row as new as the one held, or older, changes
    nothing, so snapshots without news write nothing. The table lies in ``buckets`` by key; only buckets with a change
    are written, under the batch's own name, and the manifest, moved into place by one rename, names each bucket's
    folder and the last batch. So a batch that failed half-way is done over, and one that is run again is passed over.
    Rows with a null key are left out. ``buckets`` stays as first given."""
    spark, last = batch.sparkSession, manifest_of(batch.sparkSession, root, name)
    if last and batch_id <= last["batch"]:
        return False
    folders, buckets = (last or {}).get("folders", {}), (last or {}).get("buckets", buckets)
    content = sorted(batch.columns)
    age = F.struct(*order, F.col("mark"))
    news = batch.where(" and ".join(f"`{k}` is not null" for k in key)).withColumn("mark", fingerprint(content))
    news = news.groupBy(*key).agg(F.max_by(F.struct(*content, "mark"), age).alias("r")).select("r.*").withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    held = None
    if folders:
        held = spark.read.schema(news.schema).parquet(*[f"{root}/{name}/{f}" for f in folders.values()])
        stored = held.select(*key, *[F.col(c).alias(f"_{c}") for c in (*order, "mark") if c not in key], F.lit(True).alias("_held"))
        old_age = F.struct(*[F.col(c if c in key else f"_{c}") for c in (*order, "mark")])
        newer = F.col("_held").isNull() | ((age > old_age) & (F.col("mark") != F.col("_mark")))
        news = news.join(stored, key, "left").where(newer).select(held.columns)
    news = written(news, "news")
    changed = sorted(r[0] for r in news.select("bucket").distinct().collect())  # buckets, a fixed number
    if changed:
        table = news
        if held is not None:
            touched = [f"{root}/{name}/{folders[str(b)]}" for b in changed if str(b) in folders]
            if touched:
                table = table.unionByName(spark.read.schema(news.schema).parquet(*touched).join(news.select(*key), key, "left_anti"))
        place = f"batch={batch_id}"
        table.withColumn("in", F.col("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("in").parquet(f"{root}/{name}/{place}")
        folders = {**folders, **{str(b): f"{place}/in={b}" for b in changed}}
    forget(news)
    commit(spark, root, name, {"batch": batch_id, "buckets": buckets, "folders": folders, "schema": batch.schema.jsonValue()})
    return True


def upserted(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table that ``upsert_batch`` keeps."""
    from pyspark.sql.types import StructType

    manifest = manifest_of(spark, root, name)
    schema = StructType.fromJson(manifest["schema"])
    if not manifest["folders"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{name}/{f}" for f in manifest["folders"].values()])


def prune(spark: SparkSession, root: str, name: str) -> list[str]:
    """Removes what no committed generation of ``publish_parts`` or ``upsert_batch`` reads any more; returns the folders."""
    manifest, base = manifest_of(spark, root, name), f"{root}/{name}"
    path, fs = hadoop(spark, base)
    if "parts" in manifest:
        used = {f"gen={r[0]}" for r in spark.read.parquet(f"{base}/parts/{manifest['parts']}").select("gen").distinct().collect()}
        folders = [f"rows/{s.getPath().getName()}" for s in fs.listStatus(hadoop(spark, f"{base}/rows")[0])]
        gone = [f for f in folders if f.startswith("rows/gen=") and f[5:] not in used]
        gone += [f"parts/{s.getPath().getName()}" for s in fs.listStatus(hadoop(spark, f"{base}/parts")[0]) if s.getPath().getName() != manifest["parts"]]
    else:
        used = {f.split("/")[0] for f in manifest["folders"].values()}
        gone = [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=") and s.getPath().getName() not in used]
    for folder in gone:
        fs.delete(hadoop(spark, f"{base}/{folder}")[0], True)
    return sorted(gone)

"""Recurring feeds as Structured Streaming jobs. The same expressions run in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.generations import upsert_batch

EDITION = ("28 days", "7 days 9 hours 1 minute")  # 2020-01-02 09:01 UTC lies so far into a 28-day period


def edition_window(events: DataFrame, late: str = "3 days") -> DataFrame:
    """Records of each 28-day edition; records later than ``late`` behind the newest are dropped in a stream."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", EDITION[0], startTime=EDITION[1])).agg(F.count("*").alias("n")).select(F.col("window.start").alias("edition"), "n")


def deduplicated(events: DataFrame, key: str, late: str = "1 day") -> DataFrame:
    """Each id once within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def running_history(facts: DataFrame) -> DataFrame:
    """Counts and first and last sighting of each user and kind, for update mode."""
    return facts.groupBy("user_id", "event_type").agg(F.count("*").alias("uses"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def late_editions(events: DataFrame, cutoff: str) -> DataFrame:
    """The newest record of each user at the cutoff: later ones are not yet in force, older ones never displace it."""
    return events.where(F.col("ts") <= F.lit(cutoff).cast("timestamp")).groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


def read_stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    path = f"{folder}/{table}.parquet"
    # a stream source lists a folder; the glob also takes a table that is one file
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def drained(stream: DataFrame, path: str, mode: str = "append", seconds: int | None = None) -> DataFrame:
    """Runs a stream over what has arrived and returns what it wrote. In update mode the last row of each key counts.

    Sink and state lie under ``path``, a folder that executors share. ``seconds`` bounds the wait, as tests may want;
    without it the stream ends when all that has arrived is read."""
    spark = stream.sparkSession
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start()
    else:
        query = stream.writeStream.foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/out/run={n}")).option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start()
    try:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError("the stream did not end in time")
    finally:
        query.stop()
    return spark.read.parquet(f"{path}/out")


def upserting(stream: DataFrame, root: str, name: str, key: list[str], order: list[str], state: str, buckets: int = 64, seconds: int | None = None) -> None:
    """Brings all that has arrived into the table ``name`` under ``root``, a batch at a time, the newest row of a key counting.

    ``state`` holds the stream's progress; a batch that it hands over twice changes the table once (see ``upsert_batch``)."""
    query = stream.writeStream.foreachBatch(lambda df, n: upsert_batch(df, n, root, name, key, order, buckets) and None).option("checkpointLocation", state).trigger(availableNow=True).start()
    try:
        if seconds is None:
            query.awaitTermination()
        elif not query.awaitTermination(seconds):
            raise TimeoutError("the stream did not end in time")
    finally:
        query.stop()

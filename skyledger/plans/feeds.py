"""Queries over streams and their batch twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.storage import shared_folder
from skyledger.streaming import feeds as R

from .query import Query, Tables, query

QUERIES: list[Query] = []


def place(t: Tables) -> str:
    return f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"


@query(QUERIES, "SELECT user_id, max_by(event_id, ts) AS event_id FROM events WHERE ts <= TIMESTAMP '2024-01-15' GROUP BY 1")
def q_late_editions(t: Tables) -> DataFrame:
    return R.late_editions(t.events, "2024-01-15")


@query(QUERIES, "SELECT DISTINCT event_id, user_id FROM events")
def q_stream_dedupe(t: Tables) -> DataFrame:
    stream = R.deduplicated(R.read_stream(t.spark, t.folder, "events"), "event_id").select("event_id", "user_id")
    return R.drained(stream, place(t)).select("event_id", "user_id")


@query(QUERIES, "SELECT user_id, event_type, count(*)::BIGINT AS uses, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1, 2")
def q_stream_history(t: Tables) -> DataFrame:
    rows = R.drained(R.running_history(R.read_stream(t.spark, t.folder, "events")), place(t), "update")
    last = rows.groupBy("user_id", "event_type").agg(F.max_by(F.struct("uses", "first_seen", "last_seen"), "batch").alias("s"))
    return last.select("user_id", "event_type", "s.*")

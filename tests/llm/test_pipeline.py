import re

import duckdb
import pytest

import corpus_pipeline
from skyledger.llm import queries, tiling

from test_nearcopies import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_each_act_on_what_is_left(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        kept[name] = docs.count()
        if name == "near-dedup":
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} == brute([(r["doc_id"], r["text"]) for r in before.collect()])
        if name == "decontamination":
            assert tiling.contamination(docs, bench).count() == 0
        if name == "mixture":
            words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
            total = sum(words(r["text"]) for r in before.collect())
            assert sum(words(r["text"]) for r in docs.collect()) == pytest.approx(total, rel=0.2)
        assert docs.columns == (names if name != "sharding" else [*names, "slot", "shard"])
    assert kept["sharding"] == kept["mixture"] and kept["language ID"] > kept["near-dedup"] > kept["decontamination"] > 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found, want = queries.queries()[name](spark, FOLDER), con.sql(queries.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(found.columns) == columns
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(want.select(*columns).fetchall(), key=repr)

"""Parts of bounded size, generations that reuse them, upserts that may run twice."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.sources import generations as G
from skyledger.streaming import feeds

SCHEMA = "kind string, z int, id int, body string"


def rows(n, seed=1):
    rng = random.Random(seed)
    return [("hot" if i % 3 else rng.choice(["a", "b", "c d/e"]), rng.choice([3, 4]), i, "x" * rng.choice([1, 5, 20, 90, 400])) for i in range(n)]


def publish(spark, root, data, most=200, most_rows=12):
    return G.publish_parts(spark.createDataFrame(data, SCHEMA), root, "t", ["id"], ["id"], ["body"], F.length("body"), most, most_rows)


def test_parts_hold_both_limits_and_generations_reuse_them(spark, tmp_path):
    root, data = f"file://{tmp_path}", rows(400)
    first = publish(spark, root, data)
    assert first["rows"] == first["written_rows"] == 400 and first["reused_rows"] == 0

    def held():
        return sorted(((r["kind"], r["z"], r["id"], r["body"]) for r in G.current_rows(spark, root, "t").collect()), key=repr)

    def parts():
        manifest = G.manifest_of(spark, root, "t")
        return G.rows_of(spark, root, "t", manifest).groupBy("gen", "kind", "z", "part").agg(F.count("*").alias("n"), F.sum(F.length("body")).alias("bytes")).collect()

    assert held() == sorted(data, key=repr)
    for p in parts():
        assert p["n"] <= 12 and (p["bytes"] <= 200 or p["n"] == 1)
    assert len(parts()) == first["n_parts"] < 330
    again = publish(spark, root, data)
    assert (again["reused_rows"], again["written_rows"]) == (400, 0) and held() == sorted(data, key=repr)
    changed = [(k, z, i, b + "!" if i == 7 else b) for k, z, i, b in data if i != 100] + [("new", 3, 1000, "n")]
    third = publish(spark, root, changed)
    assert third["rows"] == 400 and 2 < third["written_rows"] < 40 and held() == sorted(changed, key=repr)
    for p in parts():
        assert p["n"] <= 12 and (p["bytes"] <= 200 or p["n"] == 1)
    gone = G.prune(spark, root, "t")
    assert gone and held() == sorted(changed, key=repr)
    assert publish(spark, root, [])["rows"] == 0 and held() == []
    with pytest.raises(ValueError):
        publish(spark, root, [("a", 1, 1, "x"), ("a", 1, 1, "y")])
    with pytest.raises(ValueError):
        publish(spark, root, [(None, 1, 1, "x")])


def test_many_small_parts_share_few_files(spark, tmp_path):
    root, data = f"file://{tmp_path}", rows(900)
    made = publish(spark, root, data, most_rows=3)
    files = list(tmp_path.rglob("rows/**/*.parquet"))
    assert made["n_parts"] > 300 and len(files) <= 8
    held = spark.read.parquet(f"{root}/t/rows").select("kind", "z", "part", F.input_file_name().alias("file"))
    assert held.groupBy("kind", "z", "part").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()


def test_a_run_that_stops_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    root, data = f"file://{tmp_path}", rows(30)
    publish(spark, root, data)
    with monkeypatch.context() as m:
        m.setattr(G, "commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            publish(spark, root, rows(30, seed=9))
    assert sorted((r["id"], r["body"]) for r in G.current_rows(spark, root, "t").collect()) == sorted((i, b) for _, _, i, b in data)


EVENTS = "id int, v string, ts int, k string"


def test_upserts_that_run_twice(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    put = lambda data, n: G.upsert_batch(spark.createDataFrame(data, EVENTS), n, root, "u", ["id"], ["ts"], 4)
    held = lambda: {r["id"]: (r["v"], r["ts"]) for r in G.upserted(spark, root, "u").collect()}
    first = [(i, "a", 10, None) for i in range(20)] + [(3, "late", 5, "x"), (None, "no key", 1, None)]
    assert put(first, 0) and held() == {i: ("a", 10) for i in range(20)}
    second = [(1, "b", 11, None), (1, "c", 12, None), (2, "old", 9, None), (50, "new", 1, None)]
    with monkeypatch.context() as m:  # a batch that stops before its manifest is done over
        m.setattr(G, "commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            put(second, 1)
    assert held() == {i: ("a", 10) for i in range(20)}
    assert put(second, 1)
    want = {i: ("a", 10) for i in range(20)} | {1: ("c", 12), 50: ("new", 1)}
    assert held() == want
    assert not put(second, 1) and not put([(1, "again", 99, None)], 0) and held() == want  # handed over twice
    before = G.manifest_of(spark, root, "u")["folders"]
    assert put(first, 2) and held() == want and G.manifest_of(spark, root, "u")["folders"] == before  # nothing new, nothing written
    assert put([(1, "z", 13, None)], 3) and sum(f != before.get(b) for b, f in G.manifest_of(spark, root, "u")["folders"].items()) == 1
    G.prune(spark, root, "u")
    assert held() == want | {1: ("z", 13)}


def test_a_stream_in_several_batches_gives_the_table_of_one(spark, tmp_path):
    rng, folder = random.Random(2), tmp_path / "in"
    data = [(rng.randrange(30), f"v{i}", rng.randrange(1000), None) for i in range(300)]
    for k in range(3):
        spark.createDataFrame(data[k * 100 : k * 100 + 100], EVENTS).coalesce(1).write.mode("append").parquet(str(folder))
    stream = lambda n: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", n).parquet(str(folder))
    tables = []
    for n in (1, 10):
        root = f"file://{tmp_path}/out{n}"
        feeds.upserting(stream(n), root, "t", ["id"], ["ts", "v"], f"{root}/state", 4, seconds=120)
        feeds.upserting(stream(n), root, "t", ["id"], ["ts", "v"], f"{root}/state", 4, seconds=120)  # nothing has arrived since
        tables.append(sorted(tuple(r) for r in G.upserted(spark, root, "t").select("id", "v", "ts").collect()))
    best = {}
    for i, v, ts, _ in data:
        best[i] = max(best.get(i, (-1, "")), (ts, v))
    assert tables[0] == tables[1] == sorted((i, v, ts) for i, (ts, v) in best.items())


def test_editions_close_behind_the_watermark(spark, tmp_path):
    rows = [(i, f"2020-01-{d:02d} {h}") for i, (d, h) in enumerate([(2, "09:00:59"), (2, "09:01:00"), (15, "12:00:00"), (30, "09:00:59"), (30, "09:01:00")])] + [(9, "2020-02-01 00:00:00"), (10, "2020-02-03 00:00:00")]
    spark.createDataFrame(rows, "id int, ts string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, ts timestamp").parquet(str(tmp_path / "in"))
    found = feeds.drained(feeds.edition_window(stream), f"file://{tmp_path}/out", seconds=120).collect()
    assert sorted((str(r["edition"]), r["n"]) for r in found) == [("2019-12-05 09:01:00", 1), ("2020-01-02 09:01:00", 3)]

"""Stages decide row by row: rows that share an id, odd rows, empty tables, and columns whose names stages use themselves."""

import pytest

import corpus_pipeline
from skyledger.llm import langid, tiling

FOLDER = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, bad string, letters string, key string, id_ string, none_ string, hash_ string, node string, component string, slot string, shard string, item_id string, size string, row string, whole string, part string, times string"


def test_clean_rows_stay_beside_rejected_ones_of_the_same_id(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"so {item} end"), (1, "a clean text of other words")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [r["text"] for r in tiling.decontaminated(docs, bench).collect()] == ["a clean text of other words"]
    real = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    first = langid.known_language(real).orderBy("doc_id").first()
    both = real.unionByName(spark.createDataFrame([(first["doc_id"], "123 456", None)], real.schema))
    kept = langid.known_language(both).where(f"doc_id = {first['doc_id']}").collect()
    assert [r["text"] for r in kept] == [first["text"]]


@pytest.fixture(scope="module")
def clashing(spark):
    """Clean rows, each unlike the others, with repeated ids, without an id, of one hot source; then odd rows."""
    real = spark.read.parquet(f"{FOLDER}/documents.parquet").where("lang = 'en' and length(text) > 400").orderBy("doc_id").limit(12).collect()
    clean = [(None if k == 3 else 7 if k in (4, 5, 6) else k, " ".join(f"{w}{k}" for w in r["text"].split()[:80]), "en", "s" if k % 3 else None, 1) for k, r in enumerate(real)]
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "", None, "s", 0), (20, " \n", "en", None, 2)]
    return spark.createDataFrame([(*row, *["x"] * 16) for row in clean + odd], CLASHING)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_clashing_names(spark, clashing, name, stage):
    found = stage(spark, clashing, FOLDER)
    own = [c for c in clashing.columns if c not in ("slot", "shard")] + ["slot", "shard"] if name == "sharding" else clashing.columns
    assert found.columns == own
    rows = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in found.collect())
    clean = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in clashing.where("length(text) > 5").collect())
    if name == "mixture":
        assert {r[2] for r in rows} <= {r[2] for r in clean} and rows
        return
    assert [r for r in rows if len(r[2]) > 5] == clean
    assert len(rows) - len(clean) == {"language ID": 0, "near-dedup": 1, "decontamination": 4, "sharding": 4}[name]
    assert stage(spark, clashing.limit(0), FOLDER).count() == 0

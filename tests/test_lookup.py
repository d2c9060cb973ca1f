"""Searches in one pass against the operators over an index."""

import math

from pyspark.sql import functions as F

from skyledger.operators import lookup
from skyledger.operators import text as X

TEXTS = [(1, "alpha beta gamma delta runway"), (2, "alpha beta gamma delta"), (3, "alpha beta gamma delta rumway"), (4, "Alphabet beta, gamma delta runways runway"), (5, None), (6, "instrumentatoin a navigation navigaxionxl"), (7, "internationalisatoin approach aproach")]
ASKED = [(9, "alpha beta runway"), (10, "a"), (11, "instrumentation"), (12, "internationalisation"), (13, "approach"), (14, "missing"), (15, "navigational")]


def tables(spark):
    docs = spark.createDataFrame(TEXTS, "d int, text string")
    return docs, spark.createDataFrame([(q, t) for q, s in ASKED for t in s.split()], "q int, term string")


def found(df):
    return {(r["q"], r["d"]): round(r["score"], 9) for r in df.collect()}


def test_one_pass_finds_what_the_index_finds(spark):
    docs, terms = tables(spark)
    index = X.inverted_index(docs, "d", ["text"]).localCheckpoint()
    words = index.select(F.col("term").alias("word"))
    assert found(lookup.search_texts(terms, docs, "q", "d", "text")) == found(X.search(terms, index, "q", "d", {"text": 1.0}, len(TEXTS)))
    weighted = found(X.weighted_search(terms, index, words, "q", "d", {"text": 1.0}, len(TEXTS)))
    assert found(lookup.search_texts(terms, docs, "q", "d", "text", "weighted")) == weighted and len(weighted) > 8
    near = index.withColumnRenamed("term", "word").join(X.fuzzy_terms(terms, words), "word").groupBy("term", "d", "field").agg(F.sum("n").alias("n"))
    assert found(lookup.search_texts(terms, docs, "q", "d", "text", "near")) == found(X.search(terms, near, "q", "d", {"text": 1.0}, len(TEXTS)))


def test_searches_spread_no_text_over_its_words(spark, tmp_path):
    from skyledger.plans import registry

    spark.createDataFrame([(d, x) for d, x in TEXTS], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ASKED, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("q_search_all", "q_search_near"):
        assert "Generate" not in registry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_and_repeated_documents(spark, monkeypatch):
    docs, terms = tables(spark)
    whole = found(lookup.search_texts(terms, docs, "q", "d", "text", "near"))
    monkeypatch.setattr(lookup, "ROWS", 2)
    assert found(lookup.search_texts(terms, docs, "q", "d", "text", "near")) == whole
    split = spark.createDataFrame([(1, "alpha"), (1, "beta runway")], "d int, text string")
    assert found(lookup.search_texts(terms.where("q = 9"), split, "q", "d", "text")) == {(9, 1): round(3 * math.log(2) * math.log(3), 9)}


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_terms_against_all_pairs():
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms, words = sorted({word(rng.randint(1, 22)) for _ in range(120)}), {word(rng.randint(1, 22)) for _ in range(150)}
    words |= {t[:3] + t[4:] for t in terms} | {t[:5] + "c" + t[5:8] + t[9:] for t in terms if len(t) > 9} | set(terms) | {t + "ab" for t in terms}
    assert all(lookup.edits(t, w) == plain_edits(t, w) for t in terms[:40] for w in sorted(words)[:200])
    known = lookup.Terms(terms, "near")
    for w in words - {""}:
        assert {terms[i] for i in known.of(w)[0]} == {t for t in terms if w.startswith(t) or plain_edits(t, w) <= len(t) // 5}

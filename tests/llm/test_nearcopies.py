"""Near copies of the pipeline against all pairs."""

import random

from skyledger.llm import nearcopies as N

NAMES = "doc_id long, text string, source string"


def varied(rng, words, n):
    """``words`` with ``n`` of them replaced."""
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def sample():
    rng = random.Random(3)
    texts = []
    for _ in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        texts += [base, *[varied(rng, base, rng.randrange(1, 6)) for _ in range(rng.randrange(4))]]
    hub = [f"h{rng.randrange(3000)}" for _ in range(200)]
    texts += [hub, *[varied(rng, hub, 4) for _ in range(80)]]  # each is near the first, hardly one near another
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def brute(rows, least=0.8):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in ids}


def test_near_copies_agree_with_all_pairs(spark):
    rows = sample()
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], NAMES)
    want = brute(rows)
    assert len(want) < len(rows) - 80
    assert {r["doc_id"] for r in N.one_of_near_copies(docs).collect()} == want


def test_pipeline_stage_drops_near_copies_beyond_four_bits(spark):
    import corpus_pipeline

    rng = random.Random(5)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    docs = spark.createDataFrame([(i, " ".join(varied(rng, base, 3) if i else base), "s") for i in range(12)], NAMES)
    stage = dict(corpus_pipeline.STAGES)["near-dedup"]
    assert [r["doc_id"] for r in stage(spark, docs, "").collect()] == [0]


def test_rows_that_share_an_id_and_odd_rows(spark):
    rows = [(1, "one text of its own"), (1, "and quite another one"), (2, "One  text of its own"), (3, None), (4, " "), (None, ""), (None, "no id at all"), (None, "no id at all"), (5, "and quite another one")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], NAMES)
    kept = N.one_of_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, "no id at all"), (1, "and quite another one"), (1, "one text of its own"), (3, "")]
    assert N.one_of_near_copies(docs.limit(0)).count() == 0

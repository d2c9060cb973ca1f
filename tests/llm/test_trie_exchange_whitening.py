"""The conversation trie, exact duplicates and whitening against brute force, with odd rows and small bounds."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from skyledger.llm import exchange, trie, whitening

# 11: conversation prefix trie

TURNS = "conv_id long, turn long, role string, text string, seq string, shard string, key string, n long"


def brute_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), role, tie, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        turns = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((c, d == len(turns)))
    found = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = ",".join(map(str, sorted(c for c, whole in members if whole)))
        found.append(
            (
                min(members)[0], len(path), min(nodes[path[:-1]])[0] if path else None, len(members), sum(len(p) == len(path) + 1 for p in below), sum(not any(q[: len(p)] == p and len(q) > len(p) for q in below) for p in below),
                sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def nodes_of(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def conversations(seed):
    rng, rows = random.Random(seed), []
    for c in [*range(-103, -97), *range(0, 60), *range(130, 160), *range(200, 230)]:
        for turn in range(rng.choice([0, 1, 2, 5, 9])):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "bot", None]), rng.choice(["hi", "é" * 3, "", None, "x" * rng.randint(1, 3)])))
    rows += [(300 + k, t, "user", "same") for k in range(40) for t in range(3)]  # many copies
    rows += [(7, t, "user", str(t)) for t in range(300)] + [(8, t, "user", str(t)) for t in range(280)]  # long ones that share turns
    rows += [(None, 1, "user", "nobody"), (5, 3, "a", "twice"), (5, 3, "a", "twice"), (5, 3, "b", "tie"), (5, 3, "b", "another tie")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_bytes", [trie.SHARD_BYTES, 700])
def test_trie_of_all_prefixes(spark, shard_bytes):
    rows = conversations(shard_bytes)
    df = spark.createDataFrame([(*r, "s", "h", "k", 1) for r in rows], TURNS)
    assert nodes_of(trie.conversation_trie(df, shard_bytes)) == brute_trie(rows)


def test_trie_without_turns_or_rows(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")).count() == 0
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6)  # its base is absent, so its only turn goes
    rows = [(lone, 0, "user", "gone")]
    found = nodes_of(trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert found == brute_trie(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_member_lists_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = [(b"k%d" % (i % 3), i - 20) for i in range(200)] + [(b"z", 10**i) for i in range(12)]
    found = {bytes(r["key"]): bytes(r["ends"]) for r in trie.member_digests(spark.createDataFrame(rows, "key binary, conv_id long")).collect()}
    want = {k: hashlib.sha256(",".join(str(i) for i in sorted(i for q, i in rows if q == k)).encode()).digest() for k in {k for k, _ in rows}}
    assert found == want


def test_ternary_tree_is_balanced_by_medians():
    assert sorted(trie.medians(100)) == list(range(100)) and next(trie.medians(101)) == 50 and list(trie.medians(0)) == []
    tree = trie.TernaryTree()
    for i in trie.medians(1000):
        tree.insert([i, 5], 1, i)
    deepest = 0
    for code in range(1000):
        at, steps = tree.equal[0], 0
        while tree.code[at] != code:
            at, steps = (tree.low if code < tree.code[at] else tree.high)[at], steps + 1
        deepest = max(deepest, steps)
    assert deepest < 10 and tree.members[0] == 1000 and tree.least[0] == 0


# 12: exact duplicates


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    found = []
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        kept = [i == best for i in ids]
        extra = kept.count(True) - 1
        for i, k in sorted(zip(ids, kept, strict=True), key=lambda x: not x[1]):
            if k and extra:
                k, extra = False, extra - 1
            found.append((i, best, len(ids), k, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(found, key=repr)


def exact_rows(df):
    return sorted((tuple(r[n] for n in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=repr)


CLASHING = "doc_id long, text string, file string, place long, digest string, size long, bucket long, best string, _metadata string"


def duplicates():
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "", " ", "a", "A", "b" * 50_000, f"only {i}", f"only {i}", f"only {i}"])) for i in range(600)]
    rows += [(1000 + i, "one text that fills a third") for i in range(300)]
    return rows + [(5, "tie"), (5, "tie"), (5, "tie"), (None, "no id"), (None, "no id"), (None, None), (4, "no id"), (-3, "é"), (-2, "é")]


@pytest.mark.parametrize("spare", [8, -4])
def test_exact_duplicates(spark, monkeypatch, spare):
    monkeypatch.setattr(exchange, "SPARE_BITS", spare)  # with -4 most fingerprints collide, and bytes must tell texts apart
    monkeypatch.setattr(exchange, "SENDER_ROWS", 50)
    rows = duplicates()
    df = spark.createDataFrame([(i, t, "f", 1, "d", 1, 2, "b", "m") for i, t in rows], CLASHING).repartition(5)
    assert exact_rows(exchange.exact_duplicates(df, owners=3)) == brute_exact(rows)


def test_exact_duplicates_of_files_in_waves(spark, tmp_path):
    rows = duplicates()
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    assert exact_rows(exchange.exact_duplicates(docs, wave_buckets=2)) == brute_exact(rows)
    assert exact_rows(exchange.exact_duplicates(docs.where("doc_id < 300"))) == brute_exact([r for r in rows if r[0] is not None and r[0] < 300])
    assert exact_rows(exchange.exact_duplicates(docs.unionByName(docs))) == brute_exact(rows + rows)


def test_exact_duplicates_of_nothing(spark):
    assert exchange.exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("bits", [1, 7, 20, 32])
def test_golomb_codes(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 2, 500):
        values = np.unique(rng.integers(0, 1 << bits, n))
        k, code = exchange.golomb(values, bits)
        assert np.array_equal(exchange.golomb_values(k, len(values), code), values)
    dense = np.sort(rng.choice(1 << 20, 5000, replace=False))
    assert len(exchange.golomb(dense, 20)[1]) < 5000 * 10 / 8  # under ten bits each; the bound is near 9.2


# 13: whitening


def vectors(seed=0, n=400, d=9):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.4
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(m)]


def whitened(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "c") for i, v in rows], "vec_id long, embedding array<float>, x string").repartition(3)
    return whitening.whiten(df, **how).collect()


def test_whitening_against_a_symmetric_solver(spark):
    good = vectors()
    rows = good + [(900 + i, v) for i, (_, v) in enumerate(good[:50])] + [(3, good[3][1])] * 200  # copies, repeated rows
    bad = [(800, None), (801, []), (802, [None] * 9), (803, [1.0] * 8 + [float("nan")]), (804, [float("inf")] + [0.0] * 8), (805, [1.0] * 4), (None, good[1][1])]
    found = whitened(spark, rows + bad, components=16)
    grid = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    fit = np.array(sorted({tuple(x) for x in grid.values()}), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    centred = ((fit * n - total) / n).astype(float)
    value, axes = np.linalg.eigh(centred.T @ centred / n)
    value, axes = value[::-1], axes[:, ::-1]
    assert len(found) == (len(rows) + 1) * 9 and {r["n"] for r in found} == {n} and sum(r["vec_id"] is None for r in found) == 9
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-10
    sign = {}
    for r in found:
        x, j = grid[1 if r["vec_id"] is None else r["vec_id"]], r["component"] - 1
        assert r["deviation"] == sum(int(n * a - s) ** 2 for a, s in zip(x, total, strict=True))
        assert r["explained"] == pytest.approx(value[j] / value.sum(), rel=1e-9)
        want = float(((np.array([n * a - s for a, s in zip(x, total, strict=True)], dtype=object) / n).astype(float) @ axes[:, j]) / math.sqrt(value[j]))
        sign.setdefault(j, 1 if want * r["whitened"] > 0 else -1)
        assert r["whitened"] == pytest.approx(sign[j] * want, abs=1e-8)


def test_whitening_of_few_vectors(spark):
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)]
    assert {r["component"] for r in whitened(spark, line)} == {1} and whitened(spark, line)[0]["explained"] == pytest.approx(1.0)
    assert whitened(spark, [(1, [1.0, 2.0])] * 3) == []
    assert whitened(spark, [(1, None), (2, [])]) == [] and whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    large = [(1, [2.0**33, 0.0]), (2, [0.0, 2.0**33]), (3, [0.0, 0.0])]
    assert all(r["deviation"] is None for r in whitened(spark, large) if r["vec_id"] != 3)


def test_axes_of_graded_and_of_equal_eigenvalues():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    value = 10.0 ** -np.arange(0, 6, 0.2)
    value[5:8] = value[5]
    found, axes = whitening.principal_axes(q * value @ q.T)
    assert np.allclose(found, np.sort(value)[::-1], rtol=1e-8) and np.allclose(axes.T @ axes, np.eye(30), atol=1e-12)
    a = q * value @ q.T
    assert np.allclose(a @ axes, axes * found, atol=1e-14)
    assert {frozenset((int(a), int(b))) for p, q in whitening.rounds_of(7) for a, b in zip(p, q, strict=True)} == {frozenset((a, b)) for a in range(7) for b in range(a)}

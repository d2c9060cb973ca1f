"""The training-data operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyledger.llm import ctw, flac, langid, license, mixing, nearcopies, placement, quality, queries, repair, simhash, tiling

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, size string, key string, fp string"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "word"), (4, "word"), (None, "no id at all"), (None, None), (5, "é ü 　 x"), (6, "long " * 40_000), (7, "a b c d e f g"), (8, "A B C D E F G")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names operators use themselves."""
    rows = [(i, t, None if k % 2 else "en", None if k % 3 == 0 else f"s{k % 2}", 0, "x", "y", "z", "w") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# 1: context-tree weighting


def brute_ctw(train, texts, depth):
    """Nodes by (context, prefix bits) in dictionaries; weights by recursion over the whole tree."""
    count = {}

    def path(stream, i):
        return [bytes(stream[i - d : i][::-1]) for d in range(depth + 1)]

    def streams(t):
        return b"\xff" * depth + lower(t).encode() + b"\xff"

    for t in train:
        s = streams(t)
        for i in range(depth, len(s)):
            for context in path(s, i):
                for j in range(8):
                    node = count.setdefault((context, 1 << j | s[i] >> (8 - j)), [0, 0])
                    node[s[i] >> (7 - j) & 1] += 1
    kids = {}
    for context, prefix in count:
        if context:
            kids.setdefault((context[:-1], prefix), []).append((context, prefix))
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
    total = {}
    for node in sorted(count, key=lambda n: -len(n[0])):
        own = kt(count[node])
        total[node] = own if len(node[0]) == depth else math.log(0.5) + np.logaddexp(own, sum(total[k] for k in kids.get(node, [])))
    out = []
    for t in texts:
        s, score = streams(t), 0.0
        for i in range(depth, len(s)):
            contexts = path(s, i)
            for j in range(8):
                prefix, p = 1 << j | s[i] >> (8 - j), None
                for context in reversed(contexts):
                    node = (context, prefix)
                    if node in count:
                        own = (count[node][1] + 0.5) / (sum(count[node]) + 1)
                        w = math.exp(math.log(0.5) + kt(count[node]) - total[node]) if len(context) < depth else 1.0
                        p = own if p is None else w * own + (1 - w) * p
                p = 0.5 if p is None else p
                score += math.log10(p if s[i] >> (7 - j) & 1 else 1 - p)
        out.append(score)
    return out


def test_ctw_scores_match_brute_force(spark):
    texts = ["the cat sat on the mat", "the cat", "", None, "A cat on THE mat", "zzz", "the dog sat on the log", "é"]
    rows = list(enumerate(texts))
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    found = {r["doc_id"]: r for r in ctw.ctw_scores(spark.createDataFrame(rows, "doc_id long, text string"), depth=3).collect()}
    for i, want in enumerate(brute_ctw(train, texts, 3)):
        assert found[i]["score"] == pytest.approx(want, abs=1e-4)
    tokens = [w for t in train for w in [*words(lower(t)), "\n"]]
    for i, t in rows:
        mine = [*words(lower(t)), "\n"]
        base = sum(math.log10((tokens.count(w) + 0.5) / (len(tokens) + 0.5 * (len(set(tokens)) + 1))) for w in mine)
        assert found[i]["base_score"] == pytest.approx(base)
        assert (found[i]["n_tokens"], found[i]["n_known"], found[i]["train_tokens"]) == (len(mine), sum(w in tokens for w in mine), len(tokens))


def test_ctw_scores_do_not_depend_on_where_rows_come_from(spark, docs):
    few = docs.where("doc_id < 40")
    scanned = sorted((r["doc_id"], round(r["score"], 4)) for r in ctw.ctw_scores(few).collect())
    shuffled = sorted((r["doc_id"], round(r["score"], 4)) for r in ctw.ctw_scores(few.repartition(5, "doc_id")).collect())
    assert scanned == shuffled and scanned


def test_ctw_in_many_buckets_and_parts_after_settings_change(spark, docs):
    """Small buckets and parts of cells agree with large ones, also where the scan is split otherwise by the time it runs."""
    few = docs.where("doc_id < 60").select("doc_id", "text")
    want = sorted((r["doc_id"], round(r["score"], 6)) for r in ctw.ctw_scores(few).collect())
    split = ctw.ctw_scores(few, bucket_bytes=1 << 12, part_bytes=1 << 8)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert sorted((r["doc_id"], round(r["score"], 6)) for r in split.collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ctw_is_a_distribution():
    keys = np.frombuffer(os.urandom(400), np.uint8) % 4 + 97
    data = keys.astype(np.uint8)
    grams, _ = ctw.grams(data, np.array([0]), np.array([len(data)]), 2)
    k, n = ctw.merged([grams.astype(np.int64)], [np.ones(len(grams), np.int64)])
    tops = []
    levels = {}
    for context in np.unique(k >> 8):
        mine = k >> 8 == context
        nodes = ctw.tree(k[mine], n[mine], 2)
        top = np.zeros((3, 256))
        top[:, (nodes[2][0] & np.uint64(255)).astype(int)] = nodes[2][1], nodes[2][2], nodes[2][4]
        tops.append((int(context) >> 8, top))
        levels[int(context)] = ctw.unpacked(ctw.packed(nodes, 2))
    first = {}
    for c, top in tops:
        first[c] = first.get(c, 0) + top
    upper = ctw.upper_levels([{"first": c, "top": t.tobytes()} for c, t in first.items()])
    for context, level in list(levels.items())[:5]:
        all_bytes = np.arange(256) + (context << 8)
        assert (10 ** ctw.log10_of(all_bytes, level, upper, 2)).sum() == pytest.approx(1)


# 2: mixing


def test_mix_meets_targets_and_reruns_agree(docs):
    one, two = (sorted(map(tuple, mixing.mix(d).select("doc_id", "size", "target", "taken", "key").collect())) for d in (docs, docs.repartition(7)))
    assert one == two
    by = {}
    for _, size, target, taken, source in one:
        assert 0 <= taken <= 3 * size
        by.setdefault(source, [target, 0])[1] += taken
    assert all(math.floor(t) == n for t, n in by.values())


def test_mix_with_preferences_is_unequal(docs):
    found = mixing.mix(docs, preference=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    share = {r["odd"]: r["x"] for r in found.groupBy((F.col("doc_id") % 2).alias("odd")).agg((F.sum("taken") / F.sum("size")).alias("x")).collect()}
    assert share[0] > share[1]
    for r in found.groupBy("key").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.sum(F.col("copies") * F.col("size")).alias("c")).collect():
        assert math.floor(r["t"]) == r["n"] and r["c"] == pytest.approx(r["n"], rel=1e-9, abs=1e-6)


def test_mix_of_repeated_ids_gives_equal_parts(spark):
    rows = [(1, "a b c d e", "x")] * 40 + [(2, None, "x"), (3, "", None), (4, "w " * 30, "y"), (None, "q r s", "z")]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == 44 and len({r["taken"] for r in found if r["doc_id"] == 1}) == 1
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    mine = [r for r in found if r["key"] == "ax"]
    assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 41


def test_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("aa", 10), ("ab", 1000), ("ac", 1000), ("b", 0)], "key string, source_size long")
    found = {r["key"]: r["target"] for r in mixing.targets(sizes).collect()}
    assert found["aa"] == 30 and found["b"] == 0
    assert found["ab"] == pytest.approx(1980 * 2 / 3) and sum(found.values()) == pytest.approx(2010)


# 3: FLAC


def test_flac_round_trip_checksums_and_seek():
    rng = random.Random(1)
    data = [bytes(64), b"ab" * 32, os.urandom(6400), bytes(128 + int(60 * math.sin(i / 9)) for i in range(4096)), "é".encode() * 3200, bytes(rng.choice(b"etaoin shrdlu") for _ in range(6400))]
    streams = flac.encode(data)
    assert flac.decode(streams) == data
    assert len(streams[3]) < len(data[3]) // 2
    layout = flac.Layout(streams[2])
    first, at = layout.frame_of(3000)
    assert first == 2 * flac.BLOCK and streams[2][at : at + 2] == b"\xff\xf8"
    for i in range(layout.first, len(streams[2]), 997):
        bad = bytearray(streams[2])
        bad[i] ^= 4
        with pytest.raises(ValueError):
            flac.decode([bytes(bad)])


def test_flac_query_digests(docs, odd):
    for df in (docs.limit(50), odd):
        rows = df.select("doc_id", "text").collect()
        found = sorted((r["n_bytes"], r["payload_sha256"], r["payload_bytes"], r["tail_crc32"]) for r in flac.media_round_trip(df).collect())
        want = []
        for _, t in rows:
            raw = (t or "").encode()
            p = raw + bytes(-len(raw) % 64 if raw else 64)
            want.append((len(raw), hashlib.sha256(p).hexdigest(), len(p), zlib.crc32(p[-64:])))
        assert found == sorted(want)


def test_pcm_blocks_and_seeking(docs, odd):
    for df in (docs.where("length(text) > 2000").limit(20), odd):
        media = flac.flac_table(df).cache()
        want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, flac.padded((r["text"] or "").encode())) for r in df.select("doc_id", "text").collect())
        blocks = {}
        for r in flac.pcm_blocks(media).collect():
            assert r["n_samples"] == len(r["pcm"]) <= flac.BLOCK and r["first_sample"] % flac.BLOCK == 0
            blocks.setdefault((r["doc_id"], r["first_sample"]), set()).add(bytes(r["pcm"]))
        for known, doc, payload in want:
            for i in range(0, len(payload), flac.BLOCK):
                assert payload[i : i + flac.BLOCK] in blocks[(doc if known else None, i)]
        for first, n in ((0, 10), (1000, 1500), (1023, 2), (5000, 1)):
            got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["pcm"])) for r in flac.pcm_range(media, first, n).collect())
            assert got == sorted((k, d, x[first : first + n]) for k, d, x in want)


# 4: Re-Pair


def test_repair_matches_the_tokenizer(docs, odd):
    cache = repair.cache_of(repair.tokenizer_path())
    for df in (docs.limit(60), odd):
        found = repair.encoded(df, shard_tokens=5000).orderBy("start").collect()
        want = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), [*cache.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in df.select("doc_id", "text").collect())
        assert [r["doc_id"] for r in found] == [i if known else None for (known, i), _ in want]
        crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
        assert sorted((r["n_tokens"], r["ids_crc32"]) for r in found) == sorted((len(ids), crc(ids)) for _, ids in want)
        assert [r["start"] for r in found] == np.cumsum([0, *[r["n_tokens"] for r in found]])[:-1].tolist()


def test_repair_special_strings_and_random_access():
    cache = repair.WordCache(repair.tokenizer_path())
    texts = ["it's <|endoftext|> a.b, c. (d) 12.5 don't éx İx x!", "the the the the the " * 50, "", " y z."]
    parts = []
    for t in texts:
        w = t.encode().split()
        cache.learn(set(w))
        parts.append(b"".join(cache[x] for x in w) + b"\2\0")
    blob, n = repair.packed([1, None, 3, 4], parts, cache.size)
    shard = repair.Shard(blob)
    for i, t in enumerate(texts):
        assert shard.ids(i, i + 1).tolist() == [*cache.tokenizer.encode(t, add_special_tokens=False).ids, 2]
    assert shard.doc_ids == [1, None, 3, 4] and n == shard.counts.sum() and len(shard.seq) < n / 4


def test_repair_goes_on_until_no_pair_repeats():
    rng = np.random.default_rng(2)
    ids = rng.choice(np.arange(60, dtype="<u2"), 4000, p=rng.dirichlet(np.ones(60)))
    ends = np.array([900, 900, 2500, 4000])
    rules, seq, left = repair.grammar(ids, ends, 100)
    expand = lambda x: [x] if x < 100 else [y for z in rules[x - 100].tolist() for y in expand(z)]
    assert [y for x in seq.tolist() for y in expand(x)] == ids.tolist()
    pairs = {}
    for a, b in zip([0, *left[:-1]], left, strict=True):
        for i in range(a, b - 1):
            pairs.setdefault((int(seq[i]), int(seq[i + 1])), []).append(i)
    assert all(len(p) == 1 or (len(p) == 2 and p[1] == p[0] + 1) for p in pairs.values())


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        repair.check_words_stand_alone({"normalizer": None, "pre_tokenizer": {"type": "ByteLevel"}, "model": {"type": "BPE"}})


# 5: placement


def test_lookup_table_turns_balance_and_stability():
    names = [f"s{i}" for i in range(7)]
    table = placement.lookup_table(names, 101)
    order = {s: [(placement.digest(f"offset:{s}") + j * (placement.digest(f"skip:{s}") % 100 + 1)) % 101 for j in range(101)] for s in names}
    want, turn = {}, 0
    while len(want) < 101:
        s = turn % 7
        want[next(x for x in order[names[s]] if x not in want)] = s
        turn += 1
    assert table == [want[i] for i in range(101)]
    large, less = placement.lookup_table(names, 10007), placement.lookup_table(names[:-1], 10007)
    assert sum(a != b for a, b in zip(large, less, strict=True) if a != 6) < 0.15 * 10007
    with pytest.raises(ValueError):
        placement.lookup_table(names, 100)


# 6: licences


def test_license_base_phrases_match_brute_force(docs, spark):
    extra = [(9001, "MIT License, the mit  license! cc-by-nc"), (9002, "Apache License, Version 2.0 and apache license version 2"), (9003, "mit licenses"), (9004, "this work licensed under GNU general public license version 3 ok"), (9005, "licensed under the old GNU lesser general public licence")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    found = {r["doc_id"]: r for r in license.license_scan(df).collect()}
    for r in df.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r["text"]))
        places, labels = [], set()
        for phrase, label in license.BASE:
            need = phrase.split()
            mine = [i for i in range(len(w)) if w[i : i + len(need)] == need]
            places += mine
            labels |= {label} if mine else set()
        got = found[r["doc_id"]]
        assert (got["n_words"], got["n_base"], got["base_labels"]) == (len(w), len(places), ",".join(sorted(labels)))
        assert (got["first_word"], got["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(got["labels"].split(",")) | (set() if labels else {""}) and 0 <= got["score"] <= 1
    assert found[9004]["labels"] == "gpl-3" and found[9005]["labels"] == ""


def slow_labels(text, idf):
    """Templates that stand at some start by definition, every start of every template tried."""
    w, out, best = license.parts_of(lower(text)), set(), 0.0
    for label, body, phrase in license.TEMPLATES:
        parts, need = license.parts_of(body), phrase.split()
        first = next(i for i in range(len(parts)) if parts[i : i + len(need)] == need)
        rare = set(sorted(set(parts) & set(w), key=lambda x: (-idf[x], x))[: license.RARE])
        for start in range(-first, len(w)):
            if w[start + first : start + first + len(need)] != need:
                continue
            here = [k for k, x in enumerate(parts) if 0 <= start + k < len(w) and w[start + k] == x]
            share = sum(idf[parts[k]] for k in here) / sum(idf[x] for x in parts)
            if sum(parts[k] in rare for k in here) >= license.AGREE and share >= license.COVER:
                out.add(label)
                best = max(best, share)
    return out, best


def test_license_labels_match_brute_force(docs, spark):
    rng, rows = random.Random(6), []
    for i, (_, body, _) in enumerate(license.TEMPLATES):
        for j in range(3):
            w = license.parts_of(body)
            for _ in range(j * 2):
                w[rng.randrange(len(w))] = rng.choice(["other", "the", "license"])
            rows.append((10_000 + 10 * i + j, "so it is, " + " ".join(w[: len(w) - j]) + " and more"))
            rows.append((20_000 + 10 * i + j, " ".join(w[j * len(w) // 5 :]) + " " + " ".join(w)))
    df = docs.select("doc_id", "text").limit(40).unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    idf = license.word_idf(license.with_words(df))
    found = {r["doc_id"]: r for r in license.license_scan(df).collect()}
    for r in df.collect():
        labels, best = slow_labels(r["text"], idf)
        got = found[r["doc_id"]]
        base = set(got["base_labels"].split(",")) - {""}
        assert set(got["labels"].split(",")) - {""} == labels | base
        assert got["score"] == pytest.approx(1.0 if base else best, abs=1e-6)


def test_license_idf_counts_documents(spark):
    df = spark.createDataFrame([(1, "the license"), (2, "The"), (3, None), (3, "sublicense sublicense")], "doc_id long, text string")
    idf = license.word_idf(license.with_words(df))
    assert [idf[w] for w in ("the", "sublicense", "merge")] == pytest.approx([math.log(5 / 2.5), math.log(5 / 1.5), math.log(5 / 0.5)])


def test_whole_licences_are_found_as_files_hold_them(spark):
    whole = {label: text for label, text, _ in license.WHOLE}
    lines = lambda text, mark: "".join(mark + " ".join(text.split()[i : i + 11]) + "\n" for i in range(0, len(text.split()), 11))
    rows = [(1, "Copyright (c) 2020 A. Person\n\n" + lines(whole["mit"], "")), (2, "/*\n" + lines(whole["gpl-2"], " * ") + " */\nint main() {}"), (3, lines(whole["unlicense"], "// ").upper())]
    # the five words that are rarest of all are changed one by one; the file's own rarest words are looked up
    idf = license.word_idf(license.with_words(spark.createDataFrame(rows, "doc_id long, text string")))
    gone = sorted(set(license.parts_of(whole["zlib"])), key=lambda w: (-idf[w], w))
    lost = [w for w in gone if w not in "must be plainly marked as such"][: license.RARE]
    rows += [(4, " ".join("xx" if w in lost else w for w in license.parts_of(whole["zlib"]))), (5, "sublicense merchantability noninfringement tort " * 50), (6, " ".join(license.parts_of(whole["mit"])[:20])), (7, lines(whole["bsd-3"], "# "))]
    rows += [(8, "filler text " * 30_000 + whole["isc"] + " filler" * 30_000), (9, "mit license " * 20_000)]
    got = {r["doc_id"]: r for r in license.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["labels"] for i in range(1, 10)] == ["mit", "gpl,gpl-2", "unlicense", "zlib", "", "mit", "bsd,bsd-3", "isc", "mit"]
    assert got[9]["n_base"] == 20_000 and got[8]["n_words"] == 90_000 + len(license.parts_of(whole["isc"])) and got[1]["score"] == pytest.approx(1, abs=1e-6)


def test_license_query_takes_the_phrases_of_its_contract(spark, tmp_path):
    phrases = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
    rng = random.Random(7)
    texts = [None, "", "MIT License", "the MIT License", "Released under the MIT License.", "UNDER_the\x00mit\x7flicense", "under the mit licenses", "under the m\u0130t license", "under the under the mit license", "\u00fcnder the mit license under the mit\u0085license"]
    texts += ["under the mit license " * 300 + "mit license", "Apache License, Version 2.0; apache license version 20", "CC-BY-NC cc by nc4", "\U0001f600under the mit license"]
    texts += ["".join(rng.choice("under the The mit MIT license apache version 2 cc by nc".split()) + rng.choice(" -_\n\x00\x7f") for _ in range(60)) for _ in range(40)]
    texts += [body for _, body, _ in license.TEMPLATES]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op6_license(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        places = [(k, label) for phrase, label in phrases for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        starts, labels = [k for k, _ in places], {label for _, label in places}
        got = found[i]
        assert (got["n_words"], got["n_base"], got["base_labels"]) == (len(w), len(places), ",".join(sorted(labels))), t
        assert (got["first_word"], got["last_word"]) == ((min(starts), max(starts)) if starts else (None, None)), t
        assert labels <= set(got["labels"].split(",")) | {""} and 0 <= got["score"] <= 1, t
        assert (got["labels"] == "") == (got["score"] == 0), t
    assert (found[2]["base_labels"], found[2]["labels"]) == ("", "mit") and found[2]["score"] == pytest.approx(1)


# 7 and 8: classifiers


def test_language_held_out_accuracy(docs):
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.9


def test_quality_held_out_and_compiled_rules(spark):
    folder = FOLDER.replace("0.001", "0.01")
    d, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.quality_scores(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) / len(found) > 0.9
    rule = ((0, 10.0, True), (1, 3.0, False))
    model = quality.RuleModel(-1.0, [(0, 0.0, 50.0, 5.0, 0.1)], [(rule, 2.0)])
    rows = quality.statistics(spark.createDataFrame([(1, "one two three"), (2, "x"), (3, None)], "doc_id long, text string")).withColumn("s", model.score()).collect()
    for r in rows:
        z = -1 + (min(50, r["chars"]) - 5) * 0.1 + 2 * (r["chars"] > 10 and r["words"] <= 3)
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-z)))


# 9: SimHash


def test_fingerprints_match_the_definition(docs):
    def slow(text):
        w = words(lower(text))
        s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = {r["doc_id"]: r["text"] for r in docs.limit(80).collect()}
    for r in simhash.near_duplicates(docs.limit(80)).collect():
        assert int(r["fingerprint"], 16) == slow(rows[r["doc_id"]])


@pytest.mark.parametrize("crowd", [3, 64])
def test_links_find_every_near_pair(spark, crowd):
    rng, prints = random.Random(crowd), set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(12):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 5)):
                y ^= 1 << b
            prints.add(y)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    found = simhash.connected_components(simhash.links(spark.createDataFrame(signed, "fp long"), crowd=crowd))
    root = {r["node"]: r["component"] for r in found.collect()}
    parent = {p: p for (p,) in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a,) in signed:
        for (b,) in signed:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert all(root.get(p, p) == find(p) for (p,) in signed)


# 10: tiling


def slow_tiles(a, b, least):
    """Greedy string tiling by definition: all maximal matches anew in each round."""
    used_a, used_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = []
        for p in range(len(a)):
            for q in range(len(b)):
                n = 0
                while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n] and not used_a[p + n] and not used_b[q + n]:
                    n += 1
                if n >= least:
                    best.append((-n, p, q))
        if not best:
            return sorted(out)
        n, p, q = min(best)
        for i in range(-n):
            used_a[p + i] = used_b[q + i] = True
        out.append((p, q, -n))


def test_tiles_match_the_definition():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.choice("abc") for _ in range(rng.randint(3, 14))]
        text = [rng.choice("abcd") for _ in range(rng.randint(3, 40))]
        index = tiling.Index([(1, " ".join(item))], 3)
        ids = index.ids_of([w.encode() for w in text])
        want = slow_tiles(text, item, 3)
        assert sorted(tiling.tiles(ids, index.tokens[0], 3)) == want
        assert index.candidates(ids) == ([0] if want else [])


def test_tiles_of_long_runs_of_few_words():
    item, text = np.zeros(100_000, np.int64), np.zeros(100_000, np.int64)
    assert tiling.tiles(text, item[:70_000], 5) == [(0, 0, 70_000)]
    text[::777] = -1
    found = tiling.tiles(text, item, 5)
    assert sum(t[2] for t in found) == 100_000 - 129 and len(found) == 129
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2, 3000), rng.integers(0, 2, 3000)
    found = tiling.tiles(a, b, 5)
    assert all(np.array_equal(a[p : p + n], b[q : q + n]) for p, q, n in found) and [t[2] for t in found] == sorted((t[2] for t in found), reverse=True)
    for k in (0, 1):
        spans = sorted((t[k], t[2]) for t in found)
        assert all(x + n <= y for (x, n), (y, _) in zip(spans, spans[1:], strict=False))


def test_a_text_of_one_word_against_such_an_item(spark):
    docs = spark.createDataFrame([(1, "spam " * 100_000), (2, "spam " * 40), (3, "ham")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "spam " * 50_000), (8, "ham spam " * 30_000)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"], r["covered_words"]) for r in tiling.contamination(docs, bench).collect()] == [(1, 7, 50_000)]


def test_contamination_catches_reordered_passages(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    w = item.split()
    texts = [(1, "x " + item.upper() + ", y"), (2, "q " + " ".join(w[6:]) + " q q " + " ".join(w[:6])), (3, "one two three four five only"), (4, None), (5, ""), (6, "ab cd"), (6, "ab cd")]
    bench = spark.createDataFrame([(10, item, "x"), (11, None, "x"), (12, "", "x"), (13, "ab cd", "x")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in tiling.contamination(docs, bench, block_words=10).collect())
    assert found == [(1, 10, 1.0), (2, 10, 1.0), (6, 13, 1.0), (6, 13, 1.0)]
    assert sorted(r["doc_id"] for r in tiling.decontaminated(docs, bench).collect()) == [3, 4, 5]


def test_buckets_of_files_sorted_by_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ctw, "SLICE", 50)
    texts = ["x" * 5000] * 40 + ["y" * 9000] + [None, ""] * 20 + ["z" * 10] * 2000
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(path)
    for most in (20_000, 1):
        monkeypatch.setattr(ctw, "CUT_BYTES", 64 << 20 if most > 1 else 0)
        found = ctw.bucketed(spark.read.parquet(path), most).groupBy("bucket").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"), F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).collect()
        assert sum(r["n"] for r in found) == len(texts) and all(r["b"] - r["a"] + 1 == r["n"] for r in found)
        assert all(r["bytes"] < most + 9000 for r in found) and (most == 1 or len(found) == 12)


def test_preferences_far_apart_are_told_apart(spark):
    docs = spark.createDataFrame([(i, " ".join(["w"] * 20), "a", [0.01, 0.03, 1.0, 1000.0, 0.0, float("nan"), None][i % 7]) for i in range(7000)], "doc_id long, text string, source string, liking double")
    rows = {r["liking"]: r for r in mixing.mix(docs.where("liking > 0"), weights=(1,), preference=F.col("liking"), most=3).join(docs.select("doc_id", "liking"), "doc_id").groupBy("liking").agg(F.avg("copies").alias("copies"), F.sum("taken").alias("taken")).collect()}
    assert rows[1000.0]["copies"] == 3.0 and rows[0.03]["copies"] / rows[0.01]["copies"] == pytest.approx(3.0, rel=0.02) and rows[1.0]["copies"] / rows[0.03]["copies"] == pytest.approx(1 / 0.03, rel=0.02)
    assert rows[0.03]["taken"] > rows[0.01]["taken"] > 0
    none = mixing.mix(docs.where("liking = 0 or isnan(liking) or liking is null"), weights=(1,), preference=F.col("liking")).agg(F.sum("taken")).first()[0]
    assert none == 0


# all


def runs(spark, df):
    bench = spark.createDataFrame([(1, "word word")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    return {
        "ctw": ctw.ctw_scores(df), "mix": mixing.mix(df), "flac": flac.media_round_trip(df), "repair": repair.encoded(df), "place": placement.place(df, ["a", "b"]), "license": license.license_scan(df),
        "langid": langid.identify(df), "quality": quality.quality_scores(df, labels), "simhash": simhash.near_duplicates(df), "tiling": tiling.contamination(df, bench),
    }


def test_odd_rows_have_defined_results(spark, odd):
    for name, found in runs(spark, odd).items():
        n = len(found.collect())
        assert n == (0 if name == "tiling" else len(ODD)), name


def test_empty_tables(spark, empty):
    for name, found in runs(spark, empty).items():
        assert found.collect() == [], name
    bench = spark.createDataFrame([], "item_id long, text string")
    assert tiling.contamination(empty, bench).count() == 0 and mixing.mixed_documents(empty).count() == 0 and nearcopies.one_of_near_copies(empty).count() == 0 and langid.known_language(empty).count() == 0


def test_query_columns(spark):
    made = queries.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in made) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(made)

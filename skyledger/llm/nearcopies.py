"""Near copies by the Jaccard similarity of word shingles: SimHash balls and MinHash bands propose pairs, the texts decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.graph import connected_components

from .common import LOWER_BYTES, chunks, forget, fresh, utf8, written
from .simhash import links as near_prints

BANDS, ROWS = 24, 4  # a pair of similarity s shares a band with a chance of 1 - (1 - s^4)^24: all but 3.2e-6 at 0.8
CROWD = 12  # members of a band up to which all pairs of it are proposed at once
HUBS = 256  # members of a group of a crowded band that meet all others of it in the first round; sixteen times as many in each further one


def shingles(text: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` words without case (A-Z) and spacing; a shorter text is one run, a wordless one has none."""
    words = text.translate(LOWER_BYTES).split()
    line = b" ".join(words)
    if len(words) <= size:
        return [line] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [line[s:e] for s, e in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def signatures(texts: list[bytes], size: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of each text a hash of its words, its SimHash, the number of its distinct shingles, and one key a band of the
    least values of its shingles' hashes."""
    digest = xxhash.xxh64_intdigest
    nodes = np.fromiter((digest(b" ".join(t.translate(LOWER_BYTES).split()), seed) for t in texts), np.uint64, len(texts))
    found = [[digest(s, seed) for s in shingles(t, size)] for t in texts]
    n = np.fromiter(map(len, found), np.int64, len(texts))
    distinct = np.fromiter((len(set(f)) for f in found), np.int64, len(texts))
    keys, prints = np.zeros((len(texts), BANDS), np.uint64), np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return nodes, prints, distinct, keys
    hashes = np.fromiter((h for f in found for h in f), np.uint64, int(n.sum()))
    at = (np.cumsum(n) - n)[full]
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    votes = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    prints[full] = np.packbits(2 * votes > n[full, None], axis=1).view(">u8").ravel()
    turn = np.random.default_rng(seed).integers(0, 1 << 32, (2, BANDS * ROWS), np.uint32)
    half = (hashes >> np.uint64(32)).astype(np.uint32)
    for band in range(BANDS):
        key = np.full(len(full), band + 1, np.uint64)
        for k in range(band * ROWS, band * ROWS + ROWS):
            least = np.minimum.reduceat((half ^ turn[0, k]) * (turn[1, k] | np.uint32(1)), at)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[full, band] = key
    return nodes, prints, distinct, keys


def signed(docs: DataFrame, size: int = 5, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, node, fp, n, keys): equal words are one node; wordless and null texts are one too."""

    def run(batches):
        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            for i, j in chunks(starts, ends, 1_000_000):
                nodes, prints, n, keys = signatures([data[s:e].tobytes() for s, e in zip(starts[i:j], ends[i:j], strict=True)], size, seed)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel().view(np.int64)))
                own = [batch.column(c).slice(i, j - i) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(nodes.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(n), lists], names=["doc_id", "text_hash", "node", "fp", "n", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, node long, fp long, n long, keys array<long>")


def sizes_allow(a: str, b: str, least: float) -> Column:
    """Whether sets of ``a`` and ``b`` shingles can be similar enough at all."""
    return F.least(a, b) >= least * F.greatest(a, b) - 1e-9


def by_print(nodes: DataFrame) -> DataFrame:
    """Pairs (src, dst) of nodes whose SimHashes lie within four bits, by the balls of ``simhash.links``."""
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"))
    same = nodes.join(first, "fp").where("node != first").select(F.col("first").alias("src"), F.col("node").alias("dst"))
    of = lambda end: first.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_node"))
    near = near_prints(first.select("fp")).join(of("src"), "src").join(of("dst"), "dst")
    return same.unionByName(near.select(F.least("src_node", "dst_node").alias("src"), F.greatest("src_node", "dst_node").alias("dst")))


def in_bands(nodes: DataFrame) -> DataFrame:
    """(key, node, n, m) of the bands that ``m`` > 1 nodes share. Members are counted before rows meet, so no band is gathered."""
    bands = nodes.select(F.explode("keys").alias("key"), "node", "n")
    return bands.join(bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "key")


def proposals(met: DataFrame, least: float, crowd: int) -> DataFrame:
    """Pairs (src, dst, hub, shared) of bands: all of those with ``crowd`` members or fewer; of larger ones, each member
    with the one that stands in the most and largest bands: the text that the others were made from."""
    few = met.where(f"m <= {crowd}").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("all"))
    pairs = few.select(F.explode(F.expr("flatten(transform(all, a -> transform(filter(all, b -> b.node > a.node), b -> struct(a.node as src, b.node as dst, a.n as x, b.n as y))))")).alias("p")).select("p.*", F.lit(0).alias("hub"))
    large = met.where(f"m > {crowd}")
    score = large.groupBy("node").agg(F.sum("m").alias("score"))
    hubs = large.join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("h"))
    central = large.join(hubs, "key").where("node != h.node").select(F.least("node", "h.node").alias("src"), F.greatest("node", "h.node").alias("dst"), F.col("n").alias("x"), F.col("h.n").alias("y"), F.lit(1).alias("hub"))
    return pairs.unionByName(central).where(sizes_allow("x", "y", least)).groupBy("src", "dst").agg(F.max("hub").alias("hub"), F.count("*").alias("shared"))


def shingle_sets(texts: DataFrame, size: int, seed: int) -> DataFrame:
    """(node, set): the distinct 64-bit hashes of each text's shingles."""

    def run(batches):
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            for i, j in chunks(starts, ends):
                found = [np.array(list({digest(x, seed) for x in shingles(data[s:e].tobytes(), size)}), np.uint64).view(np.int64) for s, e in zip(starts[i:j], ends[i:j], strict=True)]
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), sets], names=["node", "set"])

    return texts.mapInArrow(run, "node long, set array<long>")


def alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those (src, dst) of which the sets of shingles have a Jaccard similarity of ``least`` or more."""
    first = sets.select(F.col("node").alias("src"), F.col("set").alias("a"))
    second = sets.select(F.col("node").alias("dst"), F.col("set").alias("b"))
    met = pairs.select("src", "dst").join(first, "src").join(second, "dst").withColumn("both", F.size(F.array_intersect("a", "b")))
    return met.where((F.col("both") > 0) & (F.col("both") >= least * (F.size("a") + F.size("b") - F.col("both")) - 1e-9)).select("src", "dst")


def with_roots(df: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """Adds ``name``, the component of column ``node``, which is the node itself where ``found`` has none."""
    held = found.select(F.col("node").alias("node_"), F.col("component").alias("component_"))
    return df.join(held, F.col(node) == F.col("node_"), "left").withColumn(name, F.coalesce("component_", node)).drop("node_", "component_")


def undone(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of groups (key, node and more) with root and m, whose ``m`` members still stand in more than one component."""
    state = written(with_roots(groups, found, "node", "root"), "crowded")
    open_keys = state.groupBy("key").agg(F.count("*").alias("m"), F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("key", "m")
    return state.join(open_keys, "key")


def rare_groups(nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(key, node, n, place, first): groups by a shingle among the rarest of each node, such that no pair of ``least`` or more is lost.

    Two sets so similar share one of the first n - ceil(least * n) + 1 shingles of each, whatever the order of all
    shingles is. Ordered by how many of the nodes hold them, passages that many texts have in common come last. ``first``
    are those of a node that others hold too, in order, and ``place`` is that of the key among all ``n``."""
    held = sets.join(nodes, "node").select("node", F.size("set").alias("n"), F.explode("set").alias("key"))
    counts = held.groupBy("key").agg(F.count("*").alias("df"))
    placed = held.join(counts, "key").withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("df", "key")))
    rare = placed.where((F.col("place") <= F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1) & (F.col("df") > 1))
    first = rare.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("all"))
    return first.select("node", "n", F.transform("all", lambda x: x["key"]).alias("first"), F.explode("all").alias("x")).select("x.key", "node", "n", "x.place", "first")


def may_share_enough(least: float) -> Column:
    """Whether key is the first shingle that node and hub share, and what can follow it suffices: so each pair meets once."""
    before = lambda c: F.slice(c, 1, F.array_position(c, F.col("key")).cast("int") - 1)
    most = 1 + F.least(F.col("n") - F.col("place"), F.col("hub_n") - F.col("hub_place"))
    enough = most >= least / (1 + least) * (F.col("n") + F.col("hub_n")) - 1e-9
    return enough & ~F.arrays_overlap(before("first"), before("hub_first"))


def crowded_links(large: DataFrame, links: DataFrame, found: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Components once every pair of the crowded bands ``large`` (key, node, n) that may be similar is linked or compared.

    Bands whose members stand in one component by now are done. The members of the others meet by their rarest shingles
    instead, which texts that merely share a passage do not have in common. In each round some members of a group, drawn
    by hash, meet all others of it that stand in other components, and leave the group. The draws grow sixteenfold a
    round, so a group is done after a number of rounds that grows with the logarithm of its size, and no pair is left
    out: two members were compared, stood in one component already, or hold too many shingles that the other does not."""
    left = undone(large, found).select("node").distinct()
    groups, rounds = rare_groups(left, sets, least), 0
    while True:
        draw = F.pmod(F.xxhash64("key", "node", F.lit(rounds)), F.lit(1 << 20)) / float(1 << 20)
        state = written(undone(groups, found).withColumn("drawn", draw * F.col("m") < HUBS * 16**rounds), "crowded")
        if state.isEmpty():
            return found
        hubs = state.where("drawn").select("key", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("place").alias("hub_place"), F.col("first").alias("hub_first"), F.col("root").alias("hub_root"))
        met = state.join(hubs, "key").where((F.col("root") != F.col("hub_root")) & may_share_enough(least))
        pairs = written(met.select(F.least("node", "hub").alias("src"), F.greatest("node", "hub").alias("dst")).distinct(), "candidates")
        more = written(alike(pairs, sets, least), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            found = written(connected_components(links), "components")
        groups, rounds = state.where("not drawn").select("key", "node", "n", "place", "first"), rounds + 1


def near_copies(docs: DataFrame, least: float = 0.8, size: int = 5, seed: int = 42, crowd: int = CROWD) -> DataFrame:
    """(doc_id, text_hash, component) of each row: texts linked, directly or through others, by pairs of which the sets
    of ``size``-word shingles have a Jaccard similarity of ``least`` or more.

    Pairs come from the balls around SimHashes and, as these reach few pairs at 0.8, from MinHash bands; none is linked
    without the 64-bit hashes of its texts' shingles being compared, and none that shares a band is left out. Each text is first compared with its
    likeliest partner; of the others only pairs that this leaves apart are compared, so a large group costs about one
    comparison a member."""
    rows = written(signed(docs, size, seed), "signed")
    firsts = rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "fp", "n", "keys")).alias("row"))
    nodes = written(firsts.select("node", "row.*"), "nodes")
    met = written(in_bands(nodes), "bands")
    close = by_print(nodes.select("node", "fp")).withColumns({"hub": F.lit(0), "shared": F.lit(1).cast("long")})
    pairs = written(proposals(met, least, crowd).unionByName(close).groupBy("src", "dst").agg(F.max("hub").alias("hub"), F.sum("shared").alias("shared")), "candidates")
    ends = met.select("node").unionByName(pairs.select(F.col("src").alias("node"))).unionByName(pairs.select(F.col("dst").alias("node"))).distinct()
    wanted = nodes.join(ends, "node", "left_semi").select("node", F.coalesce("doc_id", F.lit(0)).alias("id_"), F.col("none").alias("none_"), F.col("text_hash").alias("hash_"))
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id_"), F.col("doc_id").cast("long").isNull().alias("none_"), F.xxhash64("text").alias("hash_"), "text")
    texts = named.join(wanted, ["id_", "none_", "hash_"]).select("node", "text").dropDuplicates(["node"])
    sets = written(shingle_sets(texts, size, seed), "sets")
    ways = pairs.select(F.col("src").alias("u"), F.col("dst").alias("v"), "hub", "shared").unionByName(pairs.select(F.col("dst").alias("u"), F.col("src").alias("v"), "hub", "shared"))
    best = ways.groupBy("u").agg(F.max(F.struct("hub", "shared", "v")).alias("best")).select(F.least("u", "best.v").alias("src"), F.greatest("u", "best.v").alias("dst")).distinct()
    best = written(best, "best")
    links = written(alike(best, sets, least), "links")
    found = written(connected_components(links), "components")
    apart = with_roots(with_roots(pairs.select("src", "dst").join(best, ["src", "dst"], "left_anti"), found, "src", "a"), found, "dst", "b")
    more = written(alike(apart.where("a != b"), sets, least), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        found = written(connected_components(links), "components")
    found = crowded_links(met.where(f"m > {crowd}").select("key", "node", "n"), links, found, sets, least)
    out = written(with_roots(rows.select("doc_id", "text_hash", "node"), found, "node", "component").select("doc_id", "text_hash", "component"), "copies")
    forget(rows, nodes, met, pairs, sets, best)
    return out


def one_of_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with one row of each group of near copies: that of the smallest doc_id, then of the
    smallest hash of its text.

    Rows are told apart by id and text, so rows that share an id and differ in text are judged each by itself; of rows
    equal in both one stays. Rows without an id are kept where no other of their group has one. Null, empty and
    wordless texts are copies of each other, as are texts that differ in case (A-Z) and spacing alone. An empty table
    stays empty, and columns of any name pass through."""
    first = near_copies(docs, **options).groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("row"))
    key = [fresh(docs, c) for c in ("id_", "none_", "hash_")]
    kept = first.select(F.coalesce("row.doc_id", F.lit(0)).alias(key[0]), F.col("row.none").alias(key[1]), F.col("row.text_hash").alias(key[2]))
    named = dict(zip(key, [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("doc_id").cast("long").isNull(), F.xxhash64("text")], strict=True))
    rows = docs.withColumns(named).dropDuplicates(key)  # copies go before the shuffle, which the join then shares
    return rows.join(kept, key, "left_semi").select(*docs.columns)

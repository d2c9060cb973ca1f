"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

Every byte is coded as eight binary decisions. A decision's context is the bits of the byte so far and up to
``depth`` preceding bytes; each node of that tree holds a Krichevsky-Trofimov estimate, and each node's probability
is half its own estimate and half the product of its children's, at every depth. The trained weights
``P_kt / (2 P_w)`` then mix the estimates of all depths on the path of each coded bit.

The model is never broadcast or collected. Texts are scored in buckets (neighbouring rows of a file): a bucket's distinct
words and byte n-grams, a small part of its text, are counted and dealt out by cell (the two nearest context bytes of
an n-gram, the leading bits of a word's hash), packed so that a row holds a cell's keys. Cells are summed over buckets
in a tree of bounded fan-in, looked up in, and the answers go back to their buckets. Only the two upper levels of the
tree (256 nodes' tables at most) reach the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_BYTES, LOWER_LUT, chunks, fold, runs, shared_folder, utf8, written

END = 0xFF  # no UTF-8 text holds this byte: it stands before and after every text
WORDS, GRAMS = 0, 1
END_WORD = np.uint64(xxhash.xxh3_64_intdigest(b"\n")).astype(np.int64)
HALF = math.log(0.5)
SLICE = 4096  # rows of a file whose running sum of bytes is one task's
CUT_BYTES = 64 << 20  # of cuts between buckets that are broadcast
FAN_IN = 64  # parts of a cell that meet in one sum
PART_BYTES = 64 << 20  # of a cell's sheets that meet in one group
WORD_CELLS = 10  # leading bits of a word's hash


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 7, brought back; x >= 0.5."""
    y, low = x + 7, x.astype(float).copy()
    for k in range(1, 7):
        low *= x + k
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (depth+1)-gram of each coded byte, nearest context byte first and the byte itself last, and the row of each."""
    sizes = ends - starts
    at = np.concatenate(([0], np.cumsum(sizes + depth + 1)))
    stream, coded = np.full(at[-1], END, np.uint8), np.zeros(at[-1], bool)
    for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
        first = at[i] + depth
        stream[first : first + e - s] = LOWER_LUT[data[s:e]]
        coded[first : first + e - s + 1] = True
    wide = stream.astype(np.uint64)
    keys = wide.copy()
    for j in range(1, depth + 1):
        keys[j:] |= wide[:-j] << np.uint64(8 * (depth - j + 1))
    return keys[coded], np.repeat(np.arange(len(starts)), sizes + 1)


def words_of(data: np.ndarray, s: int, e: int) -> list[bytes]:
    return data[s:e].tobytes().translate(LOWER_BYTES).split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).astype(np.int64)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    at = runs(k)
    return k[at], np.add.reduceat(n, at) if len(at) else n


def cells_of(kind: int, keys: np.ndarray, depth: int) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(64 - WORD_CELLS) if kind == WORDS else keys >> 8 * (depth - 1)).astype(np.int32)


def sheet(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Keys (8 bytes each), then their values (8 bytes each)."""
    return keys.astype(np.int64).tobytes() + values.astype(np.float64).tobytes()


def of_sheet(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 16
    return np.frombuffer(blob, np.int64, n), np.frombuffer(blob, np.float64, n, 8 * n)


def summed(group: pa.Table) -> pa.Table:
    """applyInArrow function: the sheets of one cell as one, counts of equal keys added; keys never counted fall out."""
    keys, counts = zip(*map(of_sheet, group.column("sheet").to_pylist()), strict=True)
    k, n = merged(list(keys), list(counts))
    k, n = k[n > 0], n[n > 0]
    return pa.table({"kind": group.column("kind").slice(0, 1), "cell": group.column("cell").slice(0, 1), "part": group.column("part").slice(0, 1), "sheet": pa.array([sheet(k, n)], pa.binary()), "tokens": pa.array([float(n.sum())]), "distinct": pa.array([len(k)], pa.int64())})


class Lookup:
    """An open-addressing hash table over arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2.5 * len(keys) + 1).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        left = np.arange(len(keys))
        place = self.place(keys)
        while len(left):
            free = self.keys[place] == -1
            self.keys[place[free]] = keys[left[free]]
            won = self.keys[place] == keys[left]
            self.values[place[won]] = values[left[won]]
            left, place = left[~won], (place[~won] + 1) & (1 << self.bits) - 1

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        place = self.place(wanted)
        out, found = self.values[place], self.keys[place]
        left = np.flatnonzero(found != wanted)
        place = place[left]
        while len(left):
            if (self.keys[place] == -1).any():
                raise ValueError("the input changed between two reads: a bucket asks for a key that it did not announce")
            place = (place + 1) & (1 << self.bits) - 1
            hit = self.keys[place] == wanted[left]
            out[left[hit]] = self.values[place[hit]]
            left, place = left[~hit], place[~hit]
        return out


class Tally:
    """Distinct keys of one bucket with how often training texts hold them."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size, self.limit = [], [], 0, 1_000_000

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > self.limit:
            k, n = self.done()
            self.keys, self.counts, self.size, self.limit = [k], [n], len(k), max(1_000_000, 2 * len(k))

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        return merged(self.keys, self.counts)


def counter(depth: int):
    """mapInArrow function: distinct words and n-grams of each bucket, with their training counts (0: only looked up)."""

    def count(batches):
        found: dict[int, tuple[Tally, Tally]] = {}
        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            bucket, train = np.asarray(batch.column("bucket")), np.asarray(batch.column("train"))
            for b in np.unique(bucket):
                rows = np.flatnonzero(bucket == b)
                words, tally = found.setdefault(int(b), (Tally(), Tally()))
                for i, j in chunks(starts[rows], ends[rows], 1_500_000):
                    part = rows[i:j]
                    keys, row = grams(data, starts[part], ends[part], depth)
                    keys = keys << np.uint64(1) | train[part][row].astype(np.uint64)
                    keys.sort()
                    at = runs(keys >> np.uint64(1))
                    tally.add((keys[at] >> np.uint64(1)).astype(np.int64), np.add.reduceat((keys & np.uint64(1)).astype(np.int64), at))
                    for learned in (True, False):
                        own = part[train[part] == learned]
                        text = b"\n".join(data[s:e].tobytes() for s, e in zip(starts[own], ends[own], strict=True)).translate(LOWER_BYTES)
                        hashes = np.sort(hashed(text.split())) if len(own) else np.zeros(0, np.int64)
                        at = runs(hashes)
                        times = np.diff(np.append(at, len(hashes)))
                        words.add(np.append(hashes[at], END_WORD), np.append(times, len(own)) * learned)
        for b, (words, tally) in found.items():
            for kind, (keys, counts) in ((WORDS, words.done()), (GRAMS, tally.done())):
                cell = cells_of(kind, keys, depth)
                order = np.argsort(cell, kind="stable")
                keys, counts, cell = keys[order], counts[order], cell[order]
                at = runs(cell)
                blobs = [sheet(keys[i:j], counts[i:j]) for i, j in zip(at, np.append(at[1:], len(cell)), strict=True)]
                for i in range(0, len(at), 500):
                    n = len(at[i : i + 500])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), pa.array(cell[at[i : i + 500]]), pa.array(np.full(n, b, np.int64)), pa.array(blobs[i : i + 500], pa.binary())], names=["kind", "cell", "bucket", "sheet"])

    return count


def tree(keys: np.ndarray, counts: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Nodes of depths ``depth`` to 2: key (context, bits so far), zeros, ones, weight of the own estimate, log P_w."""
    keys, counts = keys.astype(np.uint64), counts.astype(float)
    byte, nodes, below = keys & np.uint64(0xFF), {}, None
    for d in range(depth, 1, -1):
        context = keys >> np.uint64(8 * (depth - d + 1)) << np.uint64(8)
        node = np.concatenate([context | np.uint64(1 << j) | byte >> np.uint64(8 - j) for j in range(8)])
        bit = np.concatenate([byte >> np.uint64(7 - j) & np.uint64(1) for j in range(8)]).astype(bool)
        unique, at = np.unique(node, return_inverse=True)
        n = np.tile(counts, 8)
        ones = np.bincount(at, n * bit, len(unique))
        zeros = np.bincount(at, n * ~bit, len(unique))
        own = log_kt(zeros, ones)
        if below is None:
            mixed = own
        else:
            parent = below[0] >> np.uint64(16) << np.uint64(8) | below[0] & np.uint64(0xFF)
            mixed = HALF + np.logaddexp(own, np.bincount(np.searchsorted(unique, parent), below[1], len(unique)))
        weight = np.exp(HALF + own - mixed) if below is not None else np.ones(len(unique))
        nodes[d], below = (unique, zeros, ones, weight, mixed), (unique, mixed)
    return nodes


def packed(nodes: dict[int, tuple[np.ndarray, ...]], depth: int) -> bytes:
    """Depths 2 to ``depth``: how many nodes, their keys, weights and estimates of a one bit."""
    parts = []
    for d in range(2, depth + 1):
        key, zeros, ones, weight, _ = nodes[d]
        parts += [np.int64(len(key)).tobytes(), key.tobytes(), weight.astype(np.float32).tobytes(), ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32).tobytes()]
    return b"".join(parts)


def unpacked(blob: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    at, out = 0, []
    while at < len(blob):
        n = int(np.frombuffer(blob, np.int64, 1, at)[0])
        key, weight, one = (np.frombuffer(blob, kind, n, at + 8 + shift * n) for kind, shift in ((np.uint64, 0), (np.float32, 8), (np.float32, 12)))
        out.append((key, weight, one))
        at += 8 + 16 * n
    return out


def grower(depth: int):
    """applyInArrow function for the summed n-grams of one two-byte context: its part of the tree, and the totals the root needs."""

    def grow(group: pa.Table) -> pa.Table:
        keys, counts = of_sheet(group.column("sheet")[0].as_py())
        nodes = tree(keys, counts, depth)
        key, zeros, ones, _, mixed = nodes[2]
        top = np.zeros((3, 256))
        top[:, (key & np.uint64(0xFF)).astype(int)] = zeros, ones, mixed
        return pa.table({"kind": group.column("kind"), "cell": group.column("cell"), "model": pa.array([packed(nodes, depth)], pa.binary()), "top": pa.array([top.tobytes()], pa.binary())})

    return grow


def above(group: pa.Table) -> pa.Table:
    """Totals of all two-byte contexts with one nearest byte."""
    tops = sum(np.frombuffer(x, np.float64) for x in group.column("top").to_pylist())
    first = group.column("cell")[0].as_py() >> 8
    return pa.table({"first": pa.array([first], pa.int32()), "top": pa.array([tops.tobytes()], pa.binary())})


def upper_levels(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weight and estimate of a one bit of the root's 256 nodes and of those of each nearest byte; weight NaN: never seen."""
    zeros, ones, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
    for row in rows:
        zeros[row["first"]], ones[row["first"]], below[row["first"]] = np.frombuffer(row["top"], np.float64).reshape(3, 256)
    out = []
    for level in (1, 0):
        own = log_kt(zeros, ones)
        mixed = HALF + np.logaddexp(own, below)
        weight = np.where(zeros + ones > 0, np.exp(HALF + own - mixed), np.nan)
        out = [weight, (ones + 0.5) / (zeros + ones + 1), *out]
        if level:
            zeros, ones, below = zeros.sum(0), ones.sum(0), mixed.sum(0)
    return tuple(out)


def log10_of(keys: np.ndarray, levels: list, top: tuple, depth: int) -> np.ndarray:
    """log10 probability of each n-gram's last byte after its context. A context never seen passes on the estimate of the deepest one seen."""
    keys = keys.astype(np.uint64)
    byte, first = keys & np.uint64(0xFF), (keys >> np.uint64(8 * depth)).astype(int)
    total = np.zeros(len(keys))
    for j in range(8):
        prefix = np.uint64(1 << j) | byte >> np.uint64(8 - j)
        bit = (byte >> np.uint64(7 - j) & np.uint64(1)).astype(bool)
        one, seen = np.full(len(keys), 0.5), np.zeros(len(keys), bool)
        for d in range(depth, -1, -1):
            if d > 1:
                if len(levels) < d - 1:
                    continue
                table, weights, ones = levels[d - 2]
                if not len(table):
                    continue
                node = keys >> np.uint64(8 * (depth - d + 1)) << np.uint64(8) | prefix
                at = np.minimum(np.searchsorted(table, node), len(table) - 1)
                here, weight, own = table[at] == node, weights[at], ones[at]
            else:
                weight, own = (top[2][first, prefix.astype(int)], top[3][first, prefix.astype(int)]) if d else (top[0][prefix.astype(int)], top[1][prefix.astype(int)])
                here = ~np.isnan(weight)
            one = np.where(here, np.where(seen, weight * own + (1 - weight) * one, own), one)
            seen |= here
        total += np.log10(np.where(bit, one, 1 - one))
    return total


def looker(depth: int, top: tuple):
    """Cogrouped applyInArrow function: what a cell's model says of the keys that buckets ask for."""

    def look(asked: pa.Table, model: pa.Table) -> pa.Table:
        blob = model.column("model")[0].as_py() if model.num_rows else b""
        kinds = asked.column("kind").to_pylist()
        sheets = [of_sheet(x)[0] for x in asked.column("sheet").to_pylist()]
        if not sheets:
            return asked.select(["bucket", "kind", "sheet"])
        unique, at = np.unique(np.concatenate(sheets), return_inverse=True)
        if kinds[0] == WORDS:
            known, counts = of_sheet(blob)
            place = np.minimum(np.searchsorted(known, unique), max(len(known) - 1, 0))
            value = np.where(known[place] == unique, counts[place], 0.0) if len(known) else np.zeros(len(unique))
        else:
            value = log10_of(unique, unpacked(blob), top, depth)
        cuts = np.cumsum([len(s) for s in sheets])[:-1]
        out = [sheet(k, v) for k, v in zip(sheets, np.split(value[at], cuts), strict=True)]
        return pa.table({"bucket": asked.column("bucket"), "kind": asked.column("kind"), "sheet": pa.array(out, pa.binary())})

    return look


def scorer(depth: int, tokens: int, distinct: int):
    """Cogrouped applyInArrow function: scores of the texts of one bucket from the values of its words and n-grams."""
    rest = math.log10(tokens + 0.5 * (distinct + 1))

    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        kinds, sheets = np.asarray(values.column("kind")), values.column("sheet")
        tables = {}
        for k in (WORDS, GRAMS):
            keys, found = zip(*(of_sheet(sheets[int(i)].as_py()) for i in np.flatnonzero(kinds == k)), strict=True)
            tables[k] = Lookup(np.concatenate(keys), np.concatenate(found))
        data, starts, ends = utf8(docs.column("text"))
        n = len(starts)
        scores, base = np.zeros(n), np.zeros(n)
        n_tokens, n_known, n_bytes = np.zeros(n, np.int64), np.zeros(n, np.int64), ends - starts
        for i, j in chunks(starts, ends, 1_000_000):
            keys, row = grams(data, starts[i:j], ends[i:j], depth)
            scores[i:j] = np.bincount(row, tables[GRAMS](keys.view(np.int64)), j - i)
            words = [words_of(data, s, e) for s, e in zip(starts[i:j], ends[i:j], strict=True)]
            many = np.array([len(w) for w in words])
            count = tables[WORDS](np.concatenate([hashed([x for w in words for x in w]), np.full(j - i, END_WORD)]))
            row = np.concatenate([np.repeat(np.arange(j - i), many), np.arange(j - i)])
            n_tokens[i:j] = many + 1
            n_known[i:j] = np.bincount(row, count > 0, j - i).astype(np.int64)
            base[i:j] = np.bincount(row, np.log10(count + 0.5) - rest, j - i)
        bits = -scores / math.log10(2) / np.maximum(n_bytes + 1, 1)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
        held = pa.array(~np.asarray(docs.column("train")))
        return pa.table(dict(zip(names, [docs.column("doc_id"), held, *map(pa.array, (n_tokens, n_known, np.full(n, tokens, np.int64), base, scores, n_bytes.astype(np.int64), bits))], strict=True)))

    return score


def bucketed(docs: DataFrame, bucket_bytes: int) -> DataFrame:
    """(doc_id, text, bucket): a bucket is a run of rows of one Parquet file, by their places in it: those of which the
    bytes of text before them come to the same multiple of ``bucket_bytes``, so it passes that by one row at most.

    Places do not hang on how a scan is split, so a later read with other settings or fewer cores gives the same
    buckets. Running sums go by slices of ``SLICE`` rows, so a file of any length is no task's alone. Where the cuts are
    few they are broadcast, a number a bucket; else rows meet them by file. Rows that do not come straight from Parquet
    files are written first."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = written(docs.select("doc_id", "text"), "ctw-docs")
    file, row = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    sizes = written(docs.select(file, row, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")), "ctw-sizes")
    sizes = sizes.withColumn("slice", F.floor(F.col("row") / SLICE))
    ahead = F.coalesce(F.sum("bytes").over(Window.partitionBy("file").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = sizes.groupBy("file", "slice").agg(F.sum("bytes").alias("bytes")).select("file", "slice", ahead.alias("before"))
    inside = F.coalesce(F.sum("bytes").over(Window.partitionBy("file", "slice").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sizes.withColumn("inside", inside).join(before, ["file", "slice"]).groupBy("file", F.floor((F.col("before") + F.col("inside")) / bucket_bytes).alias("bucket")).agg(F.min("row").alias("cut"))
    cuts = written(placed.groupBy("file").agg(F.array_sort(F.collect_list("cut")).alias("cuts")), "ctw-cuts")
    weight = cuts.agg(F.coalesce(F.sum(F.size("cuts") * 8 + F.length("file")), F.lit(0))).first()[0]
    rows = docs.select("doc_id", "text", file, row).join(F.broadcast(cuts) if weight <= CUT_BYTES else cuts, "file")
    place = F.size(F.filter("cuts", lambda c: c <= F.col("row")))
    return rows.select("doc_id", "text", F.xxhash64("file", place).alias("bucket"))


def ctw_scores(docs: DataFrame, depth: int = 5, held_out_fold: int = 1, folds: int = 5, bucket_bytes: int = 28 << 20, part_bytes: int = PART_BYTES) -> DataFrame:
    """Log10 probability and code length per byte of every text of ``docs`` (doc_id, text).

    Learns from texts whose ``crc32(doc_id) mod folds`` is not ``held_out_fold``. The coded sequence is the text's
    bytes with A-Z lowered and one end mark, so empty and null texts score that mark alone. Repeated rows are scored
    and learned once each; a null doc_id falls into the fold of the empty string. Other columns are ignored. With no
    training text every bit costs one bit. An empty table gives an empty result.

    A cell whose sheets exceed ``part_bytes`` is summed in parts and then in a tree of bounded fan-in. What buckets ask
    of it is answered in parts of ``part_bytes``, or of its model's size if that is more: so all copies of models
    together weigh no more than what is asked, whatever the input. A cell's model is one binary value of less than 2 GB.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must lie between 2 and 6")
    shared_folder(docs.sparkSession)
    docs = bucketed(docs, bucket_bytes).withColumn("train", fold(F.col("doc_id"), folds) != held_out_fold)
    asked = written(docs.select("bucket", "train", "text").mapInArrow(counter(depth), "kind tinyint, cell int, bucket long, sheet binary"), "ctw-counts")
    volume = asked.groupBy("kind", "cell").agg(F.sum(F.length("sheet")).alias("bytes"))  # 2**16 + 2**10 cells at most
    ways = F.greatest(F.lit(1), F.ceil(F.col("bytes") / part_bytes)).cast("int")
    dealt = asked.join(F.broadcast(volume.select("kind", "cell", ways.alias("ways"))), ["kind", "cell"])

    shape = "kind tinyint, cell int, part int, sheet binary, tokens double, distinct long"
    total = dealt.withColumn("part", F.pmod(F.xxhash64("bucket"), "ways").cast("int")).groupBy("kind", "cell", "part").applyInArrow(summed, shape)
    parts = volume.agg(F.coalesce(F.max(ways), F.lit(1))).first()[0]
    while parts > 1:
        parts = -(-parts // FAN_IN)
        total = total.withColumn("part", (F.col("part") / FAN_IN).cast("int")).groupBy("kind", "cell", "part").applyInArrow(summed, shape)
    total = written(total, "ctw-totals")
    words = total.where(F.col("kind") == WORDS)
    learned = words.agg(F.coalesce(F.sum("tokens"), F.lit(0.0)).cast("long").alias("tokens"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct")).first()
    model = written(total.where((F.col("kind") == GRAMS) & (F.col("distinct") > 0)).groupBy("kind", "cell").applyInArrow(grower(depth), "kind tinyint, cell int, model binary, top binary"), "ctw-model")
    tops = model.select("cell", "top").groupBy(F.shiftright("cell", 8)).applyInArrow(above, "first int, top binary").collect()  # 256 rows at most

    told = model.select("kind", "cell", "model").unionByName(words.select("kind", "cell", F.col("sheet").alias("model")))
    held = volume.join(told.select("kind", "cell", F.length("model").alias("held")), ["kind", "cell"], "left")
    each = F.greatest(F.lit(part_bytes), F.coalesce("held", F.lit(0)))
    copies = F.broadcast(written(held.select("kind", "cell", F.greatest(F.lit(1), F.ceil(F.col("bytes") / each)).cast("int").alias("ways")), "ctw-ways"))
    told = told.join(copies, ["kind", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("ways") - 1))).drop("ways")
    asked = asked.join(copies, ["kind", "cell"]).withColumn("part", F.pmod(F.xxhash64("bucket"), "ways").cast("int")).drop("ways")
    values = asked.groupBy("kind", "cell", "part").cogroup(told.groupBy("kind", "cell", "part")).applyInArrow(looker(depth, upper_levels(tops)), "bucket long, kind tinyint, sheet binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return docs.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(scorer(depth, learned["tokens"], learned["distinct"]), schema)

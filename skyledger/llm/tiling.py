"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, forget, runs, utf8, written

BASE = np.uint64(0x9E3779B97F4A7C15)
BLOCK_WORDS = 500_000  # about as many benchmark words go out in one broadcast
#: A-Z lowered, ASCII punctuation and controls to spaces.
PLAIN = bytes(ord(" ") if c < 0x30 or chr(c) in string.punctuation or c == 0x7F else LOWER_BYTES[c] for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2**64, of every run of k tokens."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide, out = ids.astype(np.uint64), np.zeros(n, np.uint64)
    for j in range(k):
        out = out * BASE + (wide[j : j + n] + np.uint64(1))
    return out


class Index:
    """Seeds of one block of benchmark items: for each seed length, sorted hashes with item and position."""

    def __init__(self, items: list[tuple[int, str]], least: int) -> None:
        self.words: dict[bytes, int] = {}
        self.ids, self.tokens, seeds = [], [], {}
        for item, text in items:
            words = words_of((text or "").encode())
            if words:
                at = len(self.ids)
                self.ids.append(item)
                self.tokens.append(np.array([self.words.setdefault(w, len(self.words)) for w in words], np.int64))
                seeds.setdefault(min(least, len(words)), []).append(at)
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.flat = np.concatenate(self.tokens) if self.tokens else np.zeros(0, np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.seeds = {}
        for k, members in seeds.items():
            hashes = [rolling(self.tokens[i], k) for i in members]
            h, owner, at = np.concatenate(hashes), np.repeat(members, list(map(len, hashes))), np.concatenate([np.arange(len(x)) for x in hashes])
            order = np.argsort(h, kind="stable")
            self.seeds[k] = h[order], owner[order], at[order]

    def ids_of(self, words: list[bytes]) -> np.ndarray:
        """The block's numbers of words; -1 for those it does not have."""
        get = self.words.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def candidates(self, ids: np.ndarray, coverage: float = 0.0) -> list[int]:
        """Items that share a seed with a text, ascending, but for those whose words all shared seeds together cover to less than ``coverage``.

        A seed counts once, however often the text holds it, so the work is bounded by the text and the block."""
        known, found = np.concatenate(([0], np.cumsum(ids < 0))), []
        for k, (hashes, owner, at) in self.seeds.items():
            places = np.flatnonzero(known[k:] == known[:-k]) if len(ids) >= k else ()
            if not len(places):
                continue
            h = np.unique(rolling(ids, k)[places])
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            many = high - low
            if not many.any():
                continue
            seed = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            who, q = owner[seed], at[seed]
            order = np.lexsort((q, who))
            who, q = who[order], q[order]
            starts = runs(who)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(who)], strict=True):
                if int(np.minimum(np.diff(np.append(q[a:b], q[b - 1] + k)), k).sum()) >= coverage * int(self.size[who[a]]):
                    found.append(int(who[a]))
        return sorted(found)


class Windows:
    """Karp-Rabin hashes, modulo 2**64, of windows of any length over one token sequence."""

    INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        self.power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, BASE, np.uint64))))
        back = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(max(n - 1, 0), self.INVERSE, np.uint64))))[:n]
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * back, dtype=np.uint64)))

    def __call__(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.power[starts + size - 1]


def free_windows(used: np.ndarray, size: int) -> np.ndarray:
    """Where windows of ``size`` tokens start that hold no used token."""
    if len(used) < size:
        return np.zeros(0, np.int64)
    before = np.concatenate(([0], np.cumsum(used)))
    return np.flatnonzero(before[size:] == before[:-size])


def tiles(text: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling (place in text, place in item, size): the longest match of k tokens or more first, of equals the
    earliest in the text, then in the item, of which no token of either side is in an earlier tile; -1 matches nothing.

    The longest size at which free windows of both sides agree is found by halving, as hashes of all windows of one size
    take one step. All tiles of that size are laid in one pass, each place of the item being looked at once, and the
    search goes on below it. So memory is linear in both sides, and a run of one word costs no more than other text."""
    hash_text, hash_item = Windows(text), Windows(item)
    used_text, used_item = text < 0, np.zeros(len(item), bool)

    def common(size: int):
        p, q = free_windows(used_text, size), free_windows(used_item, size)
        hp, hq = hash_text(p, size), hash_item(q, size)
        met = np.isin(hp, hq)
        return p[met], hp[met], q, hq

    p = common(k)[0]
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, p, 1)
    np.add.at(cover, p + k, -1)
    used_text |= np.cumsum(cover[:-1]) == 0  # words outside every seed can be in no tile
    out, high = [], min(len(text), len(item))
    while high >= k:
        low, best = k, None
        while low <= high:
            size = (low + high + 1) // 2
            found = common(size)
            if len(found[0]):
                low, best = size + 1, (size, found)
            else:
                high = size - 1
        if best is None:
            break
        size, (p, hp, q, hq) = best
        order = np.lexsort((q, hq))
        keys, q = hq[order], q[order]
        begin = runs(keys)
        next_of = dict(zip(keys[begin].tolist(), begin.tolist(), strict=True))
        end_of = dict(zip(keys[begin].tolist(), [*begin[1:].tolist(), len(keys)], strict=True))
        places, blocked, free_from = q.tolist(), np.zeros(len(item), bool), 0
        for at, h in zip(p.tolist(), hp.tolist(), strict=True):
            if at < free_from:
                continue
            i, end = next_of[h], end_of[h]
            while i < end and blocked[places[i]]:
                i += 1
            next_of[h] = i
            if i < end and np.array_equal(text[at : at + size], item[places[i] : places[i] + size]):
                to = places[i]
                out.append((at, to, size))
                used_text[at : at + size] = used_item[to : to + size] = True
                blocked[max(0, to - size + 1) : to + size] = True
                free_from = at + size
        high = size - 1
    return out


def overlaps(held: Index, text: bytes, least: int, coverage: float) -> list[tuple]:
    """(item, tiles, longest, covered, words, share) of the items of one block that a text covers to ``coverage`` or more."""
    ids, out = held.ids_of(words_of(text)), []
    for item in held.candidates(ids, coverage):
        n = len(held.tokens[item])
        found = tiles(ids, held.tokens[item], min(least, n))
        covered = sum(t[2] for t in found)
        if found and covered / n >= coverage:
            out.append((held.ids[item], len(found), max(t[2] for t in found), covered, n, covered / n))
    return out


def blocks_of(benchmark: DataFrame, least: int, block_words: int):
    """The benchmark as broadcast seed indexes of about ``block_words`` words each, and whether it is the only one.

    One block at a time passes the driver and lies in memory: a block is freed when the next one is asked for."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-words // block_words))
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        sent = spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in block], least))
        yield sent, blocks == 1
        if blocks > 1:
            sent.destroy()


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and a benchmark item of whose words tiles cover ``coverage`` or more.

    Words are compared without case (A-Z) and ASCII punctuation. Tiles have ``least`` words or more, or all of a
    shorter item. As tiles are matched wherever they stand, passages that were reordered count in full. The benchmark
    goes out as a seed index in blocks of bounded size, one after the other, whatever its own size; documents are never
    shuffled, and each whole text is read once a block. With several blocks what each finds is written. Null and wordless texts and items match nothing. Repeated documents give repeated
    rows; rows of one item_id count as items of their own. Other columns are ignored; empty tables give no rows."""
    names = ["doc_id", "item_id", "n_tiles", "longest_tile", "covered_words", "item_words", "coverage"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def tiler(index):
        def run(batches):
            for batch in batches:
                data, starts, ends = utf8(batch.column("text"))
                rows = [(doc, *row) for doc, s, e in zip(batch.column("doc_id").to_pylist(), starts, ends, strict=True) for row in overlaps(index.value, data[s:e].tobytes(), least, coverage)]
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        return run

    rows, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for index, alone in blocks_of(benchmark, least, block_words):
        found = rows.mapInArrow(tiler(index), "doc_id long, item_id long, n_tiles long, longest_tile long, covered_words long, item_words long, coverage double")
        if not alone:
            found = written(found, "tiled")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no benchmark item (``contamination`` says what holding is).

    Each row is judged where it stands, by its own text, and goes through one block of the benchmark after the other (with
    several blocks what is left is written after each): nothing is joined or shuffled, so rows that share an id are judged apart, repeated rows
    stay as often as they come, and no column name can clash. Rows with a null id are judged alike; null, empty and
    wordless texts stay. An empty benchmark drops nothing; an empty table stays empty."""

    first = docs

    def cleaner(index):
        def run(batches):
            for batch in batches:
                data, starts, ends = utf8(batch.column("text"))
                yield batch.filter(pa.array([not overlaps(index.value, data[s:e].tobytes(), least, coverage) for s, e in zip(starts, ends, strict=True)], pa.bool_()))

        return run

    for index, alone in blocks_of(benchmark, least, block_words):
        before, docs = docs, docs.mapInArrow(cleaner(index), docs.schema)
        if not alone:
            docs = written(docs, "cleaned")
            if hasattr(before, "written_path") and before is not first:
                forget(before)
    return docs

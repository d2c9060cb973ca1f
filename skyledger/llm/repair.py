"""Token ids in a binary file format compressed by Re-Pair grammars."""

from __future__ import annotations

import importlib
import json
import string
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_BYTES, utf8, written

END_ID = 2
MAGIC, SYMBOLS = b"RPG1", 1 << 16  # symbols are 16 bits wide: ids of the vocabulary, then rules
SHARD_TOKENS = 1 << 20
CACHE_WORDS = 2_500_000
MARKS = string.punctuation.replace("'", "")
BREAK = b"<|"  # special tokens begin so; words with it are left as they are
HASH = np.uint32(2654435761)
_held: dict[str, tuple] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    return importlib.import_module("public_tokenizers").path(name)


class WordCache(dict):
    """Ids of words as 16-bit little-endian bytes. The tokenizer's pieces never span ASCII white space, so a text's ids are its words' ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cores: dict[str, bytes] = {}
        self.size = self.tokenizer.get_vocab_size()
        check_words_stand_alone(json.loads(self.tokenizer.to_str()))
        self.last = np.zeros(self.size, bool)
        self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        if self.size > SYMBOLS:
            raise ValueError("ids of this vocabulary need more than 16 bits")

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self]
        if len(self) + len(self.cores) + len(new) > CACHE_WORDS:
            self.clear()
            self.cores.clear()
            new = list(words)
        if not new:
            return
        blob = b"\n".join(new)
        if BREAK in blob:
            blob = b"\n".join([w if BREAK in w else w.translate(LOWER_BYTES) for w in new])
        else:
            blob = blob.translate(LOWER_BYTES)
        texts = blob.decode().split("\n")
        cores = [bare(x) for x in texts]
        marks = [x[len(core) :] for x, core in zip(texts, cores, strict=True)]
        known = self.cores
        self.encode({x for x in {*cores, *marks} if x not in known})
        self.update(zip(new, [known[core] + known[mark] for core, mark in zip(cores, marks, strict=True)], strict=True))

    def encode(self, words: set[str]) -> None:
        """Words of letters alone are one piece each, and a piece's last id ends a word: such words go by the hundred.
        Where a count of pieces disagrees, and for all other words, one goes at a time."""
        alone, letters = [], []
        for w in words:
            (letters if w.isalpha() else alone).append(w)
        for at in range(0, len(letters), 20_000):
            parts = [letters[i : i + 200] for i in range(at, min(at + 20_000, len(letters)), 200)]
            for part, x in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
                ids = np.array(x.ids, "<u2")
                cuts = (2 * np.flatnonzero(self.last[ids]) + 2).tolist()
                if len(cuts) == len(part):
                    line = ids.tobytes()
                    self.cores.update(zip(part, [line[i:j] for i, j in zip([0, *cuts], cuts)]))  # noqa: B905
                else:
                    alone += part
        for at in range(0, len(alone), 20_000):
            part = alone[at : at + 20_000]
            encoded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.cores.update((w, np.array(x.ids, "<u2").tobytes()) for w, x in zip(part, encoded, strict=True))


def check_words_stand_alone(tokenizer: dict) -> None:
    """Raises unless a text's ids are its words' ids and marks part as ``bare`` says: composing and lower-casing before,
    pieces of letters, of one digit and of marks, and ``</w>`` at the end of each piece."""
    before = [n.get("type") for n in (tokenizer.get("normalizer") or {}).get("normalizers", [])]
    parts = (tokenizer.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = parts[0].get("pattern", {}).get("Regex", "") if parts else ""
    model = tokenizer.get("model") or {}
    if before != ["NFC", "Replace", "Lowercase"] or [p.get("type") for p in parts] != ["Split", "ByteLevel"] or not split.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") or model.get("end_of_word_suffix") != "</w>" or model.get("dropout"):
        raise ValueError("this tokenizer does not encode words one by one; only lower-casing ones that part words, digits and marks are supported")


def bare(word: str) -> str:
    """A word without the ASCII marks it ends in. They are a piece of their own where a letter or digit stands before
    them that neither composing nor lowering turns into a letter and a mark, as for all before U+0130."""
    core = word.rstrip(MARKS)
    return core if core and core[-1] < "\u0130" and core[-1].isalnum() and "<|" not in word else word


def cache_of(path: str) -> WordCache:
    """One cache for each Python worker, which serves many tasks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _held:
        _held[path] = WordCache(path)
    return _held[path]


def grammar(ids: np.ndarray, ends: np.ndarray, first_rule: int, at_once: int = 3300, least: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs of symbols), the sequence left, and where each document ends in it.

    In each round the ``at_once`` most frequent adjacent pairs become rules, and where two of them overlap the more
    frequent one is replaced, the other waiting for the next round. Rounds go on until no pair is found ``least`` times
    or all symbols are used. Pairs never span documents, so each can be read on its own."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    rules: list[np.ndarray] = []
    n_rules = 0
    while True:
        room = min(at_once, SYMBOLS - first_rule - n_rules)
        if len(seq) < 2 or room <= 0:
            break
        pair = seq[:-1] << np.uint32(16) | seq[1:]
        inside = ~last[:-1]
        ordered = np.sort(pair[inside])
        at = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        count = np.diff(np.append(at, len(ordered)))
        keep = np.flatnonzero(count >= least)
        if not len(keep):
            break
        keep = keep[np.argsort(-count[keep], kind="stable")][:room]
        chosen = ordered[at[keep]]  # by falling frequency
        table = np.zeros(1 << 18, np.int32)  # hash of a pair to its rank; one that loses its place waits for the next round
        table[(chosen[::-1] * HASH) >> np.uint32(14)] = np.arange(len(chosen) - 1, -1, -1)
        place = table[(pair * HASH) >> np.uint32(14)]
        rank = np.where((chosen[place] == pair) & inside, place, np.int32(SYMBOLS))
        at = np.flatnonzero(rank < SYMBOLS).astype(np.int32)
        own, edge = rank[at], np.int32(SYMBOLS)
        beside = at[1:] == at[:-1] + 1
        before, after = np.append(edge, np.where(beside, own[:-1], edge)), np.append(np.where(beside, own[1:], edge), edge)
        place = np.arange(len(at), dtype=np.int32)
        offset = place - np.maximum.accumulate(np.where(own != before, place, 0))  # within a run of one pair, every other place is taken
        take = at[(offset % 2 == 0) & ((offset > 0) | (own < before)) & (own <= after)]
        seq[take] = rank[take] + (first_rule + n_rules)
        last[take] |= last[take + 1]
        stays = np.ones(len(seq), bool)
        stays[take + 1] = False
        seq, last = seq[stays], last[stays]
        rules.append(chosen)
        n_rules += len(chosen)
    flat = np.concatenate(rules) if rules else np.zeros(0, np.uint32)
    ends_left = np.flatnonzero(last) + 1
    return np.stack([flat >> np.uint32(16), flat & np.uint32(0xFFFF)], 1).astype("<u2"), seq.astype("<u2"), ends_left


def expansions(rules: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length and offset, in a flat array of ids, of what each symbol stands for. Rules refer to earlier symbols only."""
    size = np.ones(first_rule + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        size[first_rule + i] = size[a] + size[b]
    offset = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint16)
    flat[:first_rule] = np.arange(first_rule)
    places, lengths = offset.tolist(), size.tolist()
    for i, (a, b) in enumerate(rules.tolist()):
        at = places[first_rule + i]
        flat[at : at + lengths[a]] = flat[places[a] : places[a] + lengths[a]]
        flat[at + lengths[a] : at + lengths[a] + lengths[b]] = flat[places[b] : places[b] + lengths[b]]
    return size, offset, flat


def packed(doc_ids: list, parts: list[bytes], first_rule: int) -> tuple[bytes, int]:
    """One shard file: header, document ids, token counts and sequence ends, rules with expansion lengths, sequence.

    Little-endian: magic, documents, rules, symbols (u4 each), first rule (u4); doc_id i8 and null flag u1 of each
    document; tokens u4 and end in the sequence u4 of each; left and right u2 and expansion length u4 of each rule;
    the sequence, u2."""
    counts = np.array([len(p) // 2 for p in parts], np.int64)
    ids = np.frombuffer(b"".join(parts), "<u2")
    rules, seq, ends = grammar(ids, np.cumsum(counts), first_rule)
    size = np.ones(first_rule + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        size[first_rule + i] = size[a] + size[b]
    head = MAGIC + struct.pack("<IIII", len(parts), len(rules), len(seq), first_rule)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
    return head + names + counts.astype("<u4").tobytes() + ends.astype("<u4").tobytes() + rules.tobytes() + size[first_rule:].astype("<u4").tobytes() + seq.tobytes(), int(counts.sum())


class Shard:
    """A shard file opened: any document's ids can be read without the others."""

    def __init__(self, blob: bytes) -> None:
        if blob[:4] != MAGIC:
            raise ValueError("not a shard file")
        n, n_rules, n_seq, self.first_rule = struct.unpack_from("<IIII", blob, 4)
        at = 20

        def read(kind: str, many: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, many, at)
            at += out.nbytes
            return out

        ids, null = read("<i8", n), read("u1", n)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null, strict=True)]
        self.counts, self.ends = read("<u4", n).astype(np.int64), read("<u4", n).astype(np.int64)
        self.rules = read("<u2", 2 * n_rules).reshape(-1, 2)
        lengths = read("<u4", n_rules)
        self.seq = read("<u2", n_seq)
        self.size, self.offset, self.flat = expansions(self.rules, self.first_rule)
        if not np.array_equal(self.size[self.first_rule :], lengths):
            raise ValueError("expansion lengths")

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Token ids of documents ``first`` up to, not including, ``last``."""
        last = len(self.ends) if last is None else last
        part = self.seq[self.ends[first - 1] if first else 0 : self.ends[last - 1] if last else 0]
        size = self.size[part]
        begin = np.cumsum(size) - size
        return self.flat[np.repeat(self.offset[part] - begin, size) + np.arange(int(size.sum()))]


def write_shards(docs: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shard files of all texts' ids as rows (part, start, n_tokens, shard), parts and starts in the order of doc_id.

    Documents are dealt out by ranges of (doc_id, hash of the text), nulls first, so one id that fills the table is
    still cut up. A shard is closed at ``shard_tokens``; ``start`` counts the tokens before it in its part."""
    path = path or tokenizer_path()

    def run(batches):
        cache, part = cache_of(path), TaskContext.get().partitionId()
        ids, parts, size, start = [], [], 0, 0
        names = ["part", "start", "n_tokens", "shard"]

        def close():
            blob, n = packed(ids, parts, cache.size)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([n], pa.int64()), pa.array([blob], pa.binary())], names=names)

        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            for a in range(0, len(starts), 500):
                texts = [data[s:e].tobytes().split() for s, e in zip(starts[a : a + 500], ends[a : a + 500], strict=True)]
                cache.learn(set().union(*texts))
                for doc, words in zip(doc_ids[a : a + 500], texts, strict=True):
                    ids.append(doc)
                    parts.append(b"".join(map(cache.__getitem__, words)) + struct.pack("<H", END_ID))
                    size += len(parts[-1]) // 2
                    if size >= shard_tokens:
                        yield close()
                        start += size
                        ids, parts, size = [], [], 0
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    return written(dealt.select("doc_id", "text").mapInArrow(run, "part int, start long, n_tokens long, shard binary"), "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the shard files.

    Only a token count for each part is put in order; there are as many parts as the writer had partitions."""
    from pyspark.sql import Window

    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens")).select("part", before.alias("before"))

    def run(batches):
        for batch in batches:
            for start, blob in zip(batch.column("start").to_pylist(), batch.column("shard"), strict=True):
                shard = Shard(blob.as_py())
                ids, at = shard.ids().astype("<u4"), np.concatenate(([0], np.cumsum(shard.counts)))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(at[:-1] + start), pa.array(shard.counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = shards.join(F.broadcast(parts), "part").select((F.col("start") + F.col("before")).alias("start"), "shard")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Every whole text's ids, with the end id, written as Re-Pair shard files and read back.

    Null and empty texts hold the end id alone. Null ids come first; rows of one id follow each other in the order of
    their texts' hashes. Other columns are ignored. An empty table gives an empty result."""
    return read_shards(write_shards(docs, path, shard_tokens))

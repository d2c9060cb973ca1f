"""Exact deduplication: owners of hash ranges mark duplicate fingerprints, only texts under suspicion are shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, written

SENDER_ROWS = 1 << 19  # rows whose fingerprints a sender orders at once
OWNER_ROWS = 1 << 21  # fingerprints that an owner meets, about
SPARE_BITS = 8  # a fingerprint without a copy is suspected with a chance of 2**-8
BUCKET = 1 << 15  # rows a bitmap of bitmap_construct_agg covers
WAVE_BUCKETS = 1 << 13  # bitmaps of 4 KB that go out in one broadcast
HOT_SHARE = 1024  # groups of more than a 1,024th of all rows: 1,024 at most


# Golomb codes


def golomb(values: np.ndarray, bits: int) -> tuple[int, bytes]:
    """Ascending values under 2**bits as Golomb codes of their steps: the divisor's exponent, and the code."""
    n = len(values)
    steps = np.diff(values, prepend=np.int64(0))
    k = max(0, int(np.floor(np.log2(max(1.0, (1 << bits) / (n + 1) * np.log(2.0))))))
    high = steps >> k
    ends = np.cumsum(high + 1 + k)  # a step: its quotient in ones, a zero, k bits of the rest
    out = np.ones(int(ends[-1]) if n else 0, np.uint8)
    out[ends - k - 1] = 0
    for b in range(k):
        out[ends - 1 - b] = steps >> b & 1
    return k, np.packbits(out).tobytes()


def golomb_values(k: int, n: int, code: bytes) -> np.ndarray:
    """The n values that ``golomb`` coded."""
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    zeros = np.flatnonzero(bits == 0).tolist()
    stops, at, z = np.empty(n, np.int64), 0, 0
    for i in range(n):
        while zeros[z] < at:
            z += 1
        stops[i] = zeros[z]
        at = zeros[z] + 1 + k
    starts = np.concatenate(([0], stops[:-1] + 1 + k)) if n else stops
    steps = stops - starts << k
    for b in range(k):
        steps |= bits[stops + k - b].astype(np.int64) << b
    return np.cumsum(steps)


class Ranges:
    """Which owner a digest belongs to, and its fingerprint within the owner's range."""

    def __init__(self, rows: int, owners: int) -> None:
        self.owners = owners
        self.bits = min(32, max(1, (rows // owners)).bit_length() + SPARE_BITS)

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        """owner * 2**bits + fingerprint of each 32-byte digest."""
        head = digests[:, :8].copy().view(">u8").ravel().astype(np.uint64)
        owner = (head >> np.uint64(32)) * np.uint64(self.owners) >> np.uint64(32)
        low = (head & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - self.bits)
        return (owner << np.uint64(self.bits) | low).astype(np.int64)


def digest_matrix(column: pa.Array) -> np.ndarray:
    """Rows of a binary column of 32 bytes each as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 32)


# The exchange


def sender(ranges: Ranges, id_type: pa.DataType):
    """mapInArrow function: rows in runs, ordered by fingerprint and cut by owner; one row a run and owner.

    ``code`` holds each fingerprint of the run once. The rows themselves stay beside it, and only the code is sent."""
    names = ["run", "owner", "n", "k", "code", "files", "which", "places", "ids", "digests"]

    def close(run: str, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        digests = digest_matrix(table.column("digest"))
        prints = ranges(digests)
        order = np.lexsort((*digests.T[::-1], prints))
        table, prints, digests = table.take(pa.array(order)), prints[order], digests[order]
        owner = prints >> ranges.bits
        cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=ranges.owners))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            once = np.unique(prints[a:b] & (1 << ranges.bits) - 1)
            k, code = golomb(once, ranges.bits)
            part = table.slice(a, b - a)
            files = part.column("file").combine_chunks().dictionary_encode()
            values = ((files.dictionary, pa.string()), (files.indices, pa.int32()), (part.column("place"), pa.int64()), (part.column("doc_id"), id_type))
            lists = [pa.array([v.to_pylist()], pa.list_(t)) for v, t in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array([run]), pa.array([int(owner[a])], pa.int32()), pa.array([len(once)], pa.int32()), pa.array([k], pa.int32()), pa.array([code], pa.binary()), *lists, pa.array([digests[a:b].tobytes()], pa.binary())],
                names=names,
            )

    def send(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= SENDER_ROWS:
                yield from close(f"{held[0].column('file')[0]}:{held[0].column('place')[0]}", held)
                held, size = [], 0
        if held:
            yield from close(f"{held[0].column('file')[0]}:{held[0].column('place')[0]}", held)

    return send


def owner_marks(messages: pa.Table) -> pa.Table:
    """What one owner answers: for each run a bitmap of the fingerprints that other runs sent too."""
    sizes = np.asarray(messages.column("n"), np.int64)
    values = [golomb_values(k, n, c.as_py()) for k, n, c in zip(messages.column("k").to_pylist(), sizes.tolist(), messages.column("code"), strict=True)]
    _, back, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    twice, cuts = count[back] > 1, np.concatenate(([0], np.cumsum(sizes)))
    marks = [np.packbits(twice[a:b]).tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.table({"run": messages.column("run"), "owner": messages.column("owner"), "marks": pa.array(marks, pa.binary())})


def opener(ranges: Ranges):
    """mapInArrow function: the rows of runs again, with whether each is under suspicion."""

    def rows(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                digests = batch.column("digests")[r].as_py()
                prints = ranges(np.frombuffer(digests, np.uint8).reshape(-1, 32))
                _, back, count = np.unique(prints, return_inverse=True, return_counts=True)
                marks = np.unpackbits(np.frombuffer(batch.column("marks")[r].as_py(), np.uint8))[: len(count)]
                suspect = (marks[back] == 1) | (count[back] > 1)
                found = pa.array([digests[i : i + 32] for i in range(0, len(digests), 32)], pa.binary())
                files, which, places, ids = (batch.column(c)[r].values for c in ("files", "which", "places", "ids"))
                yield pa.RecordBatch.from_arrays([files.take(which), places, ids, found, pa.array(suspect)], names=["file", "place", "doc_id", "digest", "suspect"])

    return rows


def marked_rows(rows: DataFrame, owners: int | None = None) -> DataFrame:
    """``rows`` (file, place, doc_id, digest) with ``suspect``: whether another row has the same fingerprint.

    A run of rows sends an owner each fingerprint once, so a text that fills the table reaches its owner once a run.
    Owners' ranges hold about ``OWNER_ROWS`` fingerprints, as digests are spread evenly."""
    spark = rows.sparkSession
    total = rows.count()
    owners = owners or max(-(-total // OWNER_ROWS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // 4096)), 1)
    ranges = Ranges(total, owners)
    id_type = rows.schema["doc_id"].dataType
    schema = f"run string, owner int, n int, k int, code binary, files array<string>, which array<int>, places array<long>, ids array<{id_type.simpleString()}>, digests binary"
    sent = written(rows.mapInArrow(sender(ranges, pa_type(id_type)), schema), "sent")
    marks = sent.select("run", "owner", "n", "k", "code").groupBy("owner").applyInArrow(owner_marks, "run string, owner int, marks binary")
    told = sent.select("run", "owner", "files", "which", "places", "ids", "digests").join(marks, ["run", "owner"])
    found = written(told.mapInArrow(opener(ranges), f"file string, place long, doc_id {id_type.simpleString()}, digest binary, suspect boolean"), "marked")
    forget(sent)
    return found


def pa_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


# Verification


def placed(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(file, place, doc_id, text) of rows read straight from Parquet files; others are written first, and that table is given too."""
    made = None
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = made = written(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "exact-docs")
        key, text = "doc_id", "text"
    return docs.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"), F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), made


def bit(bitmap: Column, at: Column) -> Column:
    """Bit ``at`` of a bitmap as bitmap_construct_agg lays it out."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def suspect_texts(texts: DataFrame, marked: DataFrame, wave_buckets: int = WAVE_BUCKETS):
    """The rows of ``texts`` that ``marked`` suspects, found by bitmaps in place of a shuffle: a DataFrame a wave.

    A wave covers files' buckets of rows whose bitmaps together stay under 32 MB and are broadcast; each wave reads its own
    files only, so all of them read the texts once."""
    from pyspark.sql import Window

    bucket = F.floor(F.col("place") / BUCKET)
    maps = written(marked.where("suspect").groupBy("file", bucket.alias("bucket")).agg(F.bitmap_construct_agg((F.col("place") % BUCKET)).alias("bitmap")), "bitmaps")
    edges = maps.select("file", "bucket", F.row_number().over(Window.orderBy("file", "bucket")).alias("i")).where((F.col("i") - 1) % wave_buckets == 0).orderBy("i").collect() if maps.count() > wave_buckets else [None]
    for w, edge in enumerate(edges):
        own, part = maps, texts
        if edge:
            low = F.struct(F.lit(edge["file"]).alias("file"), F.lit(edge["bucket"]).alias("bucket"))
            own, part = own.where(F.struct("file", "bucket") >= low), part.where(F.col("file") >= edge["file"])
            if w + 1 < len(edges):
                last = edges[w + 1]
                own = own.where(F.struct("file", "bucket") < F.struct(F.lit(last["file"]).alias("file"), F.lit(last["bucket"]).alias("bucket")))
                part = part.where(F.col("file") <= last["file"])
        yield part.withColumn("bucket", bucket).join(F.broadcast(own), ["file", "bucket"]).where(bit(F.col("bitmap"), F.col("place") % BUCKET)).select("file", "place", "doc_id", "text"), maps, len(edges)


def verified_groups(texts: DataFrame, marked: DataFrame, wave_buckets: int = WAVE_BUCKETS) -> DataFrame:
    """(digest, best, size) of each distinct text under suspicion, told apart by its bytes.

    Copies in one task become one row before the shuffle, so a text that fills the table is sent once a task."""
    best = F.max(F.struct("doc_id", F.col("file").alias("file"), F.col("place").alias("place"))).alias("best")
    parts, made = [], []
    for found, maps, waves in suspect_texts(texts, marked, wave_buckets):
        part = found.groupBy("text").agg(best, F.count("*").alias("size"))
        if waves > 1:
            part = written(part, "wave")
            made.append(part)
        parts.append(part)
    groups = parts[0]
    for part in parts[1:]:
        groups = groups.unionByName(part)
    if len(parts) > 1:
        groups = groups.groupBy("text").agg(F.max("best").alias("best"), F.sum("size").alias("size"))
    groups = written(groups.select(digest_of(F.col("text")).alias("digest"), "best", "size"), "groups")
    forget(maps, *made)
    return groups


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", owners: int | None = None, wave_buckets: int = WAVE_BUCKETS) -> DataFrame:
    """Which row of each group of equal texts stays: doc_id, keep_id, group_size, kept, text_sha256, one row a row of ``docs``.

    Texts are equal when their bytes are; null counts as empty. The row of the largest key stays, null keys being the
    least; of rows that share key and text, the one that comes last by file and place, so exactly one of a group stays.
    Rows that do not come from Parquet files are written first. Other columns are ignored. An empty table gives an
    empty result.

    Tasks order the fingerprints of their rows and send them, Golomb-coded, to the owners of hash ranges; owners send
    back bitmaps of those that came from elsewhere too. Texts of rows that are marked, or have a copy in their own run,
    are shuffled and compared by bytes, one copy a task. A row finds its verified group by its SHA-256. Groups of more
    than a 1,024th of all rows (1,024 at most) are broadcast, so that no group's rows meet in one task."""
    texts, made = placed(docs, text, key)
    marked = marked_rows(texts.select("file", "place", "doc_id", digest_of(F.col("text")).alias("digest")), owners)
    groups = verified_groups(texts, marked, wave_buckets)
    if made is not None:
        forget(made)
    total = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    hot = F.col("size") > max(total // HOT_SHARE, 1)
    alone = marked.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    shape = ["doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"), ((F.col("best.file") == F.col("file")) & (F.col("best.place") == F.col("place"))).alias("kept"), "digest"]
    suspects, large = marked.where("suspect"), F.broadcast(groups.where(hot))
    found = alone.unionByName(suspects.join(large, "digest").select(*shape))
    found = found.unionByName(suspects.join(large.select("digest"), "digest", "left_anti").join(groups.where(~hot), "digest").select(*shape))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))

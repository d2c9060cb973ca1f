"""What the operators of this subpackage share: places to write, Arrow text access, hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.storage import forget, shared_folder, written  # noqa: F401

#: ASCII white space as the text contracts define it.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
LOWER_LUT = np.frombuffer(LOWER_BYTES, np.uint8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """How many maximal runs of non-space characters; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, k: int = 5) -> Column:
    """crc32 of the decimal id modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each row starts and ends in them; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = at[:-1].copy(), at[1:].copy()
    if column.null_count:
        ends = np.where(np.asarray(column.is_null()), starts, ends)
    return data, starts, ends


def chunks(starts: np.ndarray, ends: np.ndarray, most: int = 4_000_000):
    """Runs of rows of about ``most`` bytes each; a longer row is a run of its own."""
    i, n = 0, len(starts)
    size = np.cumsum(ends - starts)
    while i < n:
        done = size[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size, done + most, "right")))
        yield i, j
        i = j


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins in an ordered array."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))

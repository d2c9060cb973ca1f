"""Media columns: bytes as 8-bit mono FLAC streams, coded and decoded frame by frame in numpy.

All frames of a batch advance together, one sample at a time, so the sequential codes (Rice, linear prediction,
checksums) cost a few vector operations a step whatever the number of documents.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, utf8, written

BLOCK, RATE, ORDER, SHIFT, PRECISION = 1024, 8000, 4, 10, 12
PAD = 64
HIGHEST_RICE = 14


def crc_table(poly: int, bits: int) -> np.ndarray:
    top, mask, out = 1 << (bits - 1), (1 << bits) - 1, []
    for c in range(256):
        c <<= bits - 8
        for _ in range(8):
            c = (c << 1 ^ poly if c & top else c << 1) & mask
        out.append(c)
    return np.array(out, np.int32)


CRC8, CRC16 = crc_table(0x07, 8), crc_table(0x8005, 16)
CRC8_LIST = CRC8.tolist()
CLZ = np.array([8 - int(x).bit_length() for x in range(256)], np.int64)


def crc8(data: bytes) -> int:
    c = 0
    for x in data:
        c = CRC8_LIST[c ^ x]
    return c


def crc16(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksum of each slice of ``data``."""
    order = np.argsort(-sizes, kind="stable")
    at, left, crc = starts[order], sizes[order], np.zeros(len(starts), np.int32)
    live = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), "right")
    for i, n in enumerate(live.tolist()):
        c = crc[:n]
        crc[:n] = (c << 8 & 0xFFFF) ^ CRC16[c >> 8 ^ data[at[:n] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def coded_number(n: int) -> bytes:
    """The frame number in the format's extension of UTF-8."""
    if n < 0x80:
        return bytes([n])
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    tail = [0x80 | n >> 6 * i & 0x3F for i in range(size - 2, -1, -1)]
    return bytes([(0xFF << (8 - size) & 0xFF) | n >> 6 * (size - 1), *tail])


def frame_header(number: int, samples: int) -> bytes:
    own = samples != BLOCK
    head = bytes([0xFF, 0xF8, (0b0111 if own else 0b1010) << 4 | 0b0100, 0b001 << 1]) + coded_number(number) + (struct.pack(">H", samples - 1) if own else b"")
    return head + bytes([crc8(head)])


def predictors(x: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Quantised linear predictors of each frame (frames, ORDER), by Levinson's recursion on autocorrelations."""
    y = (x * live).astype(np.float32)
    r = np.stack([np.einsum("ij,ij->i", y[:, k:], y[:, : y.shape[1] - k]) for k in range(ORDER + 1)], 1).astype(float)
    a, error = np.zeros((len(x), ORDER)), r[:, 0] * 1.0001 + 1e-6
    for k in range(ORDER):
        reflection = (r[:, k + 1] - sum(a[:, j] * r[:, k - j] for j in range(k))) / error
        old = a[:, :k].copy()
        a[:, k] = reflection
        a[:, :k] = old - reflection[:, None] * old[:, ::-1]
        error = np.maximum(error * (1 - reflection**2), 1e-9)
    limit = 1 << (PRECISION - 1)
    return np.clip(np.rint(a * (1 << SHIFT)), -limit, limit - 1).astype(np.int32)


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC stream of each payload (unsigned bytes, stored as signed samples), with a seek point for every frame."""
    sizes = np.array([len(p) for p in payloads], np.int64)
    many = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(payloads)), many)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    n = np.minimum(BLOCK, sizes[owner] - number * BLOCK)
    frames = len(owner)
    x = np.zeros((frames, BLOCK), np.int32)
    live = np.arange(BLOCK) < n[:, None]
    x[live] = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32) - 128

    coefficients = predictors(x, live)
    predicted = np.zeros_like(x)
    for j in range(ORDER):
        predicted[:, j + 1 :] += coefficients[:, j, None] * x[:, : -j - 1]
    lpc = x - (predicted >> SHIFT)
    first = x.copy()
    first[:, 1:] -= x[:, :-1]
    best = np.full(frames, 8, np.int64) * n
    kind, rice = np.full(frames, 1), np.zeros(frames, np.int64)  # subframe type: 1 verbatim, 0 constant, 8 and 9 fixed, 32 on LPC
    folded = np.zeros_like(x)
    for code, residual, order, extra in ((8, x, 0, 0), (9, first, 1, 8), (32 + ORDER - 1, lpc, ORDER, 8 * ORDER + 9 + PRECISION * ORDER)):
        fold = np.where(live, residual << 1 ^ residual >> 31, 0)
        fold[:, :order] = 0
        mean = fold.sum(1, dtype=np.int32) / np.maximum(n - order, 1)
        guess = np.clip(np.log2(np.maximum(mean, 1) * 0.7).astype(np.int32), 0, HIGHEST_RICE - 1)
        for k in (guess, guess + 1):
            bits = (fold >> k[:, None]).sum(1, dtype=np.int32) + (n - order) * (k + 1) + extra + 10
            better = (bits < best) & (n > 2 * ORDER)
            best, rice = np.where(better, bits, best), np.where(better, k, rice)
            kind[better] = code
        took = kind == code
        folded[took] = fold[took]
    constant = ((x == x[:, :1]) | ~live).all(1)
    kind[constant], best[constant] = 0, 8

    order = np.where(kind == 9, 1, np.where(kind >= 32, ORDER, 0))
    heads = [frame_header(int(i), int(s)) for i, s in zip(number, n, strict=True)]
    head = np.array([len(h) for h in heads])
    size = head + 1 + -(-best // 8) + 2
    start = np.cumsum(size) - size
    bits = np.zeros(8 * int(size.sum()), np.uint8)
    at = 8 * (start + head)

    def put(where: np.ndarray, value: np.ndarray, width: int) -> None:
        for b in range(width):
            bits[where + b] = value >> (width - 1 - b) & 1

    put(at, kind << 1, 8)
    at = at + 8
    f = np.flatnonzero(kind == 0)
    put(at[f], x[f, 0], 8)
    f = np.flatnonzero(kind == 1)
    row, column = np.nonzero(live[f])
    put(at[f][row] + 8 * column, x[f][row, column], 8)
    for code, many_warm in ((9, 1), (32 + ORDER - 1, ORDER)):
        f = np.flatnonzero(kind == code)
        for j in range(many_warm):
            put(at[f] + 8 * j, x[f, j], 8)
        at[f] += 8 * many_warm
        if code >= 32:
            put(at[f], np.full(len(f), (PRECISION - 1) << 5 | SHIFT), 9)
            for j in range(ORDER):
                put(at[f] + 9 + PRECISION * j, coefficients[f, j], PRECISION)
            at[f] += 9 + PRECISION * ORDER
    f = np.flatnonzero(kind > 1)
    put(at[f], rice[f], 10)  # coding method 0, partition order 0, parameter
    coded = live[f] & (np.arange(BLOCK) >= order[f, None])
    u, k = folded[f], rice[f, None]
    length = np.where(coded, (u >> k) + k + 1, 0)
    begin = np.cumsum(length, 1) - length + at[f, None] + 10
    stop = (begin + (u >> k))[coded]
    bits[stop] = 1
    u, k = u[coded], np.broadcast_to(k, coded.shape)[coded]
    for b in range(int(k.max(initial=0))):
        has = np.flatnonzero((k > b) & (u >> b & 1).astype(bool))
        bits[stop[has] + k[has] - b] = 1
    data = np.packbits(bits)
    for s, h in zip(start.tolist(), heads, strict=True):
        data[s : s + len(h)] = np.frombuffer(h, np.uint8)
    check = crc16(data, start, size - 2)
    data[start + size - 2], data[start + size - 1] = check >> 8, check & 0xFF

    out, at = [], 0
    for payload, m in zip(payloads, many.tolist(), strict=True):
        s, z = start[at : at + m], size[at : at + m]
        info = struct.pack(">HH", BLOCK, BLOCK) + int(z.min()).to_bytes(3, "big") + int(z.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(payload.translate(FLIP)).digest()
        if m * 18 >= 1 << 24:
            raise ValueError("more samples than a seek table with a point for each frame can hold (about 954 MB)")
        points = b"".join(struct.pack(">QQH", i * BLOCK, p, c) for i, (p, c) in enumerate(zip((s - s[0]).tolist(), n[at : at + m].tolist(), strict=True)))
        out.append(b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(points).to_bytes(3, "big") + points + data[s[0] : s[-1] + z[-1]].tobytes())
        at += m
    return out


FLIP = bytes(c ^ 0x80 for c in range(256))


class Layout:
    """What a stream's metadata says: samples, MD5, first frame's offset and the seek table."""

    def __init__(self, stream: bytes) -> None:
        if stream[:4] != b"fLaC":
            raise ValueError("not a FLAC stream")
        at, last = 4, False
        self.seek: list[tuple[int, int, int]] = []
        while not last:
            last, kind, size = bool(stream[at] >> 7), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
            body = stream[at + 4 : at + 4 + size]
            if kind == 0:
                packed = int.from_bytes(body[10:18], "big")
                if (packed >> 41 & 7, packed >> 36 & 31) != (0, 7):
                    raise ValueError("only 8-bit mono is read")
                self.samples, self.md5 = packed & (1 << 36) - 1, body[18:34]
            elif kind == 3:
                self.seek = [struct.unpack_from(">QQH", body, i) for i in range(0, size, 18)]
            at += 4 + size
        self.first = at

    def index_of(self, sample: int) -> int:
        """Which seek point is the last at or before ``sample``."""
        return bisect.bisect_right(self.seek, sample, key=lambda p: p[0]) - 1

    def frame_of(self, sample: int) -> tuple[int, int]:
        """First sample and byte offset of the frame that holds ``sample``."""
        found = self.seek[self.index_of(sample)]
        return found[0], self.first + found[1]


def decode(streams: list[bytes]) -> list[bytes]:
    """The payload of each stream. Header and frame checksums and the MD5 of the samples must hold."""
    layouts = [Layout(s) for s in streams]
    payloads = [b"".join(blocks) for blocks in decode_frames(streams, layouts, [(0, len(x.seek)) for x in layouts])]
    for layout, payload in zip(layouts, payloads, strict=True):
        checked(layout, payload)
    return payloads


def checked(layout: Layout, payload: bytes) -> None:
    if len(payload) != layout.samples or hashlib.md5(payload.translate(FLIP)).digest() != layout.md5:
        raise ValueError("MD5 of the samples")


def decode_frames(streams: list[bytes], layouts: list[Layout], spans: list[tuple[int, int]]) -> list[list[bytes]]:
    """PCM of the frames from one seek point up to another (not included) of each stream; other frames are not looked at.
    Header and frame checksums must hold."""
    data = np.frombuffer(b"".join(streams) + bytes(16), np.uint8)
    base = np.cumsum([0, *map(len, streams)])
    start, size, body, n = [], [], [], []
    for i, (stream, layout, span) in enumerate(zip(streams, layouts, spans, strict=True)):
        offsets = [layout.first + p[1] for p in layout.seek]
        for a, b, point in list(zip(offsets, [*offsets[1:], len(stream)], layout.seek, strict=True))[span[0] : span[1]]:
            code = stream[a + 2] >> 4
            lead = stream[a + 4]
            extra = 0 if lead < 0x80 else 8 - (~lead & 0xFF).bit_length()
            end = a + 5 + max(0, extra - 1) + {0b0110: 1, 0b0111: 2}.get(code, 0)
            if stream[a : a + 2] != b"\xff\xf8" or crc8(stream[a:end]) != stream[end]:
                raise ValueError("frame header checksum")
            start.append(int(base[i]) + a)
            size.append(b - a)
            body.append(int(base[i]) + end + 1)
            n.append(point[2])
    if not start:
        return [[] for _ in streams]
    start, size, body, n = map(np.array, (start, size, body, n))
    if (crc16(data, start, size) != 0).any():  # the checksum of a frame with its own checksum is 0
        raise ValueError("frame checksum")
    frames, most = len(start), int(n.max())
    order = np.argsort(-n, kind="stable")
    body, n_live = body[order], n[order]
    kind = data[body].astype(np.int64) >> 1
    x = np.zeros((most, frames), np.int32)
    live = np.searchsorted(-n_live, -np.arange(1, most + 1), "right")
    window = data[:-7].astype(np.uint64)
    for j in range(1, 8):
        window = window << np.uint64(8) | data[j : len(data) - 7 + j]

    def bits(at: np.ndarray, width) -> np.ndarray:
        return (window[at >> 3] << (at & 7).astype(np.uint64) >> np.uint64(64 - width)).astype(np.int64)

    def signed(value: np.ndarray, width: int) -> np.ndarray:
        return value - ((value >> (width - 1)) << width)

    at = 8 * (body.astype(np.int64) + 1)
    f = np.flatnonzero(kind == 0)
    x[:, f] = signed(bits(at[f], 8), 8)
    f = np.flatnonzero(kind == 1)
    if len(f):
        where = (at[f] >> 3) + np.arange(most)[:, None]
        x[:, f] = data[np.minimum(where, len(data) - 1)].astype(np.int8)
    coded = np.flatnonzero(kind > 1)
    warm = np.where(kind >= 32, kind - 31, np.where(kind >= 8, kind - 8, 0))
    if (kind[coded] < 8).any() or (warm > 32).any():
        raise ValueError("reserved subframe type")
    for j in range(int(warm.max(initial=0))):
        f = np.flatnonzero(warm > j)
        x[j, f] = signed(bits(at[f] + 8 * j, 8), 8)
    at += 8 * warm
    linear = np.flatnonzero(kind >= 32)
    depth = int(warm[linear].max(initial=0))
    taps, shift = np.zeros((depth, frames), np.int32), np.zeros(frames, np.int32)
    if len(linear):
        precision = bits(at[linear], 4) + 1
        shift[linear] = bits(at[linear] + 4, 5)
        for width in np.unique(precision):
            for j in range(depth):
                f = linear[(precision == width) & (warm[linear] > j)]
                taps[j, f] = signed(bits(at[f] + 9 + width * j, int(width)), int(width))
        at[linear] += 9 + precision * warm[linear]
    if len(coded):
        residuals(data, window, bits, at, coded, n_live, warm, live, x)
    for k in range(1, 5):
        f = np.flatnonzero(kind == 8 + k)
        if len(f):
            for i in range(k, most):
                x[i, f] += {1: x[i - 1, f], 2: 2 * x[i - 1, f] - x[i - 2, f], 3: 3 * x[i - 1, f] - 3 * x[i - 2, f] + x[i - 3, f], 4: 4 * x[i - 1, f] - 6 * x[i - 2, f] + 4 * x[i - 3, f] - x[i - 4, f]}[k] if k > 1 else x[i - 1, f]
    if len(linear):
        y, c, s = np.ascontiguousarray(x[:, linear]), np.ascontiguousarray(taps[:, linear]), shift[linear]
        least = int(warm[linear].min())
        for i in range(least, most):
            total = c[0] * y[i - 1]
            for j in range(1, min(depth, i)):
                total += c[j] * y[i - 1 - j]
            total >>= s
            if i < depth:
                total[warm[linear] > i] = 0
            y[i] += total
        x[:, linear] = y
    back = np.empty((frames, most), np.uint8)
    back[order] = (x + 128).astype(np.uint8).T
    out, at = [], 0
    for first, last in spans:
        out.append([back[at + i, : n[at + i]].tobytes() for i in range(last - first)])
        at += last - first
    return out


def residuals(data, window, bits, at, coded, n, warm, live, x) -> None:
    """Rice codes of the frames ``coded``, from bit ``at`` of each, into ``x``: one sample of every frame a step."""
    method, parts = bits(at[coded], 2), bits(at[coded] + 2, 4)
    if (method > 1).any():
        raise ValueError("reserved residual coding")
    width = 4 + method
    p = at[coded] + 6
    following = np.full(len(data) + 1, len(data) - 1, np.int64)
    following[:-1] = np.where(data != 0, np.arange(len(data)), len(data) - 1)
    following = np.minimum.accumulate(following[::-1])[::-1]
    length, warm, k = n[coded] >> parts, warm[coded], np.zeros(len(coded), np.int64)
    position = np.searchsorted(coded, live)  # frames come by falling length, so those still live are a prefix
    for i in range(len(live)):
        m = int(position[i])
        if not m:
            break
        fresh = np.flatnonzero((i % length[:m] == 0) | (i == 0)) if i == 0 or (parts[:m] > 0).any() else ()
        if len(fresh):
            for w in np.unique(width[fresh]):
                g = fresh[width[fresh] == w]
                k[g] = bits(p[g], int(w))
                p[g] += w
            if (k[:m] > HIGHEST_RICE).any():
                raise ValueError("escaped residuals are not read")
        here, low = p[:m], k[:m]
        byte = here >> 3
        rest = data[byte] & (0xFF >> (here & 7))
        whole = np.where(rest != 0, byte, following[byte + 1])
        stop = 8 * whole + CLZ[np.where(rest != 0, rest, data[whole])] + 1
        tail = (window[stop >> 3] << (stop & 7).astype(np.uint64) >> np.uint64(40)).astype(np.int64) >> (24 - low)
        u = (stop - 1 - here) << low | tail
        value = (u >> 1) ^ -(u & 1)
        if i < 32:
            skip = warm[:m] > i
            if skip.any():
                use = np.flatnonzero(~skip)
                x[i, coded[use]] = value[use]
                p[use] = (stop + low)[use]
                continue
        x[i, coded[:m]] = value
        p[:m] = stop + low


def padded(text: bytes, unit: int = PAD) -> bytes:
    return text + bytes(max(unit, -(-len(text) // unit) * unit) - len(text))


def flac_table(docs: DataFrame, unit: int = PAD) -> DataFrame:
    """doc_id, n_bytes and ``media``, the FLAC stream of each whole text's UTF-8 bytes padded with zeros to a positive multiple of ``unit``.

    Null texts count as empty; rows pass through one by one; other columns are ignored."""

    def run(batches):
        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            for i, j in chunks(starts, ends, 3_000_000):
                media = encode([padded(data[s:e].tobytes(), unit) for s, e in zip(starts[i:j], ends[i:j], strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(ends[i:j] - starts[i:j]), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """(doc_id, first_sample, n_samples, pcm): one row for each frame of each stored stream, 8-bit samples, with the place
    of its first sample in the document. Checksums and the MD5 of all samples must hold. Null media give no rows."""

    def run(batches):
        for batch in batches:
            column = batch.column("media")
            _, starts, ends = utf8(column)
            for i, j in chunks(starts, ends, 3_000_000):
                kept = [(d, m) for d, m in zip(batch.column("doc_id").slice(i, j - i).to_pylist(), column.slice(i, j - i).to_pylist(), strict=True) if m is not None]
                layouts, rows = [Layout(m) for _, m in kept], []
                for (doc, _), layout, blocks in zip(kept, layouts, decode_frames([m for _, m in kept], layouts, [(0, len(x.seek)) for x in layouts]), strict=True):
                    checked(layout, b"".join(blocks))
                    rows += [(doc, point[0], len(block), block) for point, block in zip(layout.seek, blocks, strict=True)]
                yield block_batch(rows)

    return media.select(F.col("doc_id").cast("long").alias("doc_id"), "media").mapInArrow(run, BLOCK_SCHEMA)


BLOCK_SCHEMA = "doc_id long, first_sample long, n_samples long, pcm binary"


def block_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, first, n, pcm = zip(*rows, strict=True) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(first, pa.int64()), pa.array(n, pa.int64()), pa.array(pcm, pa.binary())], names=["doc_id", "first_sample", "n_samples", "pcm"])


def pcm_range(media: DataFrame, first_sample: int, n_samples: int) -> DataFrame:
    """The samples ``first_sample`` up to ``first_sample + n_samples`` of each stored stream, as one row like those of
    ``pcm_blocks``. The seek table leads to the frames that hold them; no other frame is decoded. What lies beyond the
    end is left out, so a shorter stream gives fewer samples or none; null media give no rows."""

    def run(batches):
        for batch in batches:
            kept = [(d, m) for d, m in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True) if m is not None]
            layouts = [Layout(m) for _, m in kept]
            stops = [min(first_sample + n_samples, x.samples) for x in layouts]
            spans = [(x.index_of(first_sample), x.index_of(stop - 1) + 1) if stop > first_sample else (0, 0) for x, stop in zip(layouts, stops, strict=True)]
            rows = []
            for (doc, _), layout, span, stop, blocks in zip(kept, layouts, spans, stops, decode_frames([m for _, m in kept], layouts, spans), strict=True):
                skip = first_sample - layout.seek[span[0]][0] if blocks else 0
                pcm = b"".join(blocks)[skip : skip + max(0, stop - first_sample)]
                rows.append((doc, first_sample, len(pcm), pcm))
            yield block_batch(rows)

    return media.select(F.col("doc_id").cast("long").alias("doc_id"), "media").mapInArrow(run, BLOCK_SCHEMA)


def feature_of(payload: bytes, media: bytes) -> str:
    """Level, sign changes and frames of the decoded samples."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    return f"rms={float(np.sqrt((x * x).mean())):.4f};crossings={int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))};frames={-(-len(payload) // BLOCK)};stored={len(media) / len(payload):.4f}"


def flac_features(media: DataFrame, unit: int = PAD) -> DataFrame:
    """Digests and a feature of each stored stream, all from its decoded samples."""

    def run(batches):
        for batch in batches:
            column = batch.column("media")
            _, starts, ends = utf8(column)
            for i, j in chunks(starts, ends, 3_000_000):
                streams = column.slice(i, j - i).to_pylist()
                payloads = decode(streams)
                columns = [
                    batch.column("doc_id").slice(i, j - i),
                    batch.column("n_bytes").slice(i, j - i),
                    pa.array([len(p) for p in payloads], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                    pa.array([zlib.crc32(p[-unit:]) for p in payloads], pa.int64()),
                    pa.array([len(s) for s in streams], pa.int64()),
                    pa.array([hashlib.sha256(s).hexdigest() for s in streams], pa.string()),
                    pa.array([feature_of(p, s) for p, s in zip(payloads, streams, strict=True)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.mapInArrow(run, schema)


def media_round_trip(docs: DataFrame) -> DataFrame:
    """Stores every whole text as FLAC in a media column of a table in the shared folder, reads the stored streams back
    and returns what they hold. Rows pass one by one, so null ids, repeated rows and empty tables need no rule."""
    return flac_features(written(flac_table(docs), "flac", compression="zstd"))

"""Language identification by a byte convolutional network, trained in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, fold, fresh, utf8

WINDOW, EMBED, FILTERS, WIDTHS = 128, 8, 16, (2, 3, 4)
UNKNOWN = "und"


class ByteNet:
    """Byte embedding, filters of several widths, ReLU, max pooling over a window, softmax."""

    def __init__(self, classes: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"e": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), "v": np.zeros((FILTERS * len(WIDTHS), len(classes)), np.float32), "c": np.zeros(len(classes), np.float32)}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 700, batch: int = 64, rate: float = 3e-3, seed: int = 11) -> ByteNet:
        """Adam on cross-entropy over windows ``x`` (n, WINDOW) of classes ``y``."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(x), batch)
            grads = self.gradients(x[pick], y[pick])
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                self.p[k] -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, p = len(x), self.p
        e = p["e"][x]
        pooled, parts = [], []
        for w in WIDTHS:
            columns = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * EMBED)
            z = columns @ p[f"w{w}"] + p[f"b{w}"]
            at = z.argmax(1)
            best = np.take_along_axis(z, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(best, 0))
            parts.append((columns, at, best > 0))
        h = np.concatenate(pooled, 1)
        d = softmax(h @ p["v"] + p["c"])
        d[np.arange(n), y] -= 1
        d /= n
        grads = {"v": h.T @ d, "c": d.sum(0), "e": np.zeros_like(p["e"])}
        dh = d @ p["v"].T
        for i, w in enumerate(WIDTHS):
            columns, at, live = parts[i]
            g = dh[:, i * FILTERS : (i + 1) * FILTERS] * live
            taken = columns[np.arange(n)[:, None], at]
            grads[f"w{w}"] = np.einsum("nfk,nf->kf", taken, g)
            grads[f"b{w}"] = g.sum(0)
            back = (g[:, :, None] * p[f"w{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
            for j in range(w):
                np.add.at(grads["e"], np.take_along_axis(x, at + j, 1), back[:, :, j])
        return grads

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Of windows (n, WINDOW); the filters are applied as sums of byte pairs' contributions."""
        pooled = []
        e = self.p["e"]
        for w in WIDTHS:
            kernel = self.p[f"w{w}"].reshape(w, EMBED, FILTERS)
            contributions = [e @ kernel[j] for j in range(w)]
            table = (contributions[0][:, None] + contributions[1][None]).reshape(65536, FILTERS) if w == 2 else None
            if table is not None:
                z = table[x[:, :-1].astype(np.int32) << 8 | x[:, 1:]]
                best = z.max(1)
            else:
                columns = np.lib.stride_tricks.sliding_window_view(e[x], w, axis=1).transpose(0, 1, 3, 2).reshape(-1, w * EMBED)
                best = (columns @ self.p[f"w{w}"]).reshape(len(x), WINDOW - w + 1, FILTERS).max(1)
            pooled.append(np.maximum(best + self.p[f"b{w}"], 0))
        return np.concatenate(pooled, 1) @ self.p["v"] + self.p["c"]


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text cut into windows, the last filled up with zeros, and the row of each window; an empty text has one."""
    sizes = ends - starts
    many = np.maximum(1, -(-sizes // WINDOW))
    first = np.cumsum(many) - many
    out = np.zeros((int(many.sum()), WINDOW), np.uint8)
    flat = out.reshape(-1)
    for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
        flat[first[i] * WINDOW : first[i] * WINDOW + e - s] = data[s:e]
    return out, np.repeat(np.arange(len(starts)), many)


def train(docs: DataFrame, per_class: int = 400, per_text: int = 6, folds: int = 5, held_out_fold: int = 0) -> ByteNet | None:
    """A network fitted on texts with a label outside the held-out fold: about ``per_class`` texts of each language, the
    ones with the smallest hashes of id and text, and up to ``per_text`` evenly spaced windows of each.

    ``2 * per_class`` rows a language at most reach the driver, however many rows repeat one id and text."""
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (fold(F.col("doc_id"), folds) != held_out_fold))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy("lang").collect()}
    if not counts:
        return None
    draw = F.xxhash64("doc_id", "text", F.lit("langid"))
    share = F.pmod(draw, F.lit(1_000_000)) / 1e6
    limit = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, per_class / n)))])
    classes = sorted(counts)

    def cut(batches):
        for batch in batches:
            data, starts, ends = utf8(batch.column("text"))
            out = []
            for s, e in zip(starts, ends, strict=True):
                many = max(1, -(-int(e - s) // WINDOW))
                picks = sorted({round(k * (many - 1) / max(1, per_text - 1)) for k in range(per_text)})
                out.append([data[s + k * WINDOW : min(e, s + (k + 1) * WINDOW)].tobytes() for k in picks])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), batch.column("draw"), pa.array(out, pa.list_(pa.binary()))], names=["lang", "doc_id", "draw", "parts"])

    few = labelled.where(share < F.element_at(limit, F.col("lang"))).select("lang", "doc_id", draw.alias("draw"), "text")
    rows = few.mapInArrow(cut, "lang string, doc_id long, draw long, parts array<binary>").orderBy("draw").limit(2 * per_class * len(classes)).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"] or 0, r["parts"]))
    rng = np.random.default_rng(3)
    by_class = [[p for r in rows if r["lang"] == c for p in r["parts"]] for c in classes]
    per = max(map(len, by_class))
    x, y = [], []
    for k, parts in enumerate(by_class):
        if parts:
            for i in [*range(len(parts)), *rng.integers(0, len(parts), per - len(parts))]:
                x.append(np.frombuffer(parts[i].ljust(WINDOW, b"\0"), np.uint8))
                y.append(k)
    return ByteNet(classes).fit(np.stack(x), np.array(y))


def predict(net: ByteNet, batch: pa.RecordBatch, text: str, letters: str) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of a batch: every window of a text is scored and the windows' logits are averaged."""
    data, starts, ends = utf8(batch.column(text))
    n = len(starts)
    total, many = np.zeros((n, len(net.classes))), np.zeros(n)
    for i, j in chunks(starts, ends, 1_000_000):
        x, row = windows(data, starts[i:j], ends[i:j])
        for a in range(0, len(x), 2048):
            z = net.logits(x[a : a + 2048])
            for k in range(z.shape[1]):
                total[i:j, k] += np.bincount(row[a : a + 2048], z[:, k], j - i)
        many[i:j] += np.bincount(row, minlength=j - i)
    p = softmax(total / np.maximum(many, 1)[:, None])
    known = np.asarray(batch.column(letters))
    names = [net.classes[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), known, strict=True)]
    return names, np.where(known, p.max(1) if n else np.zeros(0), 0.0)


def has_letters(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, net: ByteNet | None = None, folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text of ``docs`` (doc_id, text, lang).

    Every window of a text is scored and the windows' logits are averaged. A null text and one without a letter is
    ``und`` with score 0, as is every text where no row has a label to learn from. Labels are used to train alone.
    A null doc_id falls into the fold of the empty string; rows pass through as they are; other columns are ignored."""
    net = net if net is not None else train(docs, folds=folds, held_out_fold=held_out_fold)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id"), folds) == held_out_fold).alias("held_out"), has_letters("text").alias("letters"), "text")
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            names, scores = predict(shared.value, batch, "text", "letters")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def known_language(docs: DataFrame, least: float = 0.3, net: ByteNet | None = None, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is of a known language with a score of ``least`` or more.

    Each row is judged where it stands, by its own text: nothing is joined or shuffled, so rows that share an id are
    judged apart, repeated rows stay as often as they come, and no column name can clash. Null texts and texts without
    a letter go. A null doc_id is in the fold of the empty string in training. Where no row has a label to learn from,
    no language is known and nothing is kept; an empty table stays empty."""
    net = net if net is not None else train(docs, **options)
    if net is None:
        return docs.where(F.lit(False))
    shared, letters, names = docs.sparkSession.sparkContext.broadcast(net), fresh(docs, "letters"), docs.columns

    def run(batches):
        for batch in batches:
            found, scores = predict(shared.value, batch, "text", letters)
            keep = (np.array(found, object) != UNKNOWN) & (scores >= least)
            yield batch.select(names).filter(pa.array(keep.astype(bool)))

    return docs.withColumn(letters, has_letters("text")).mapInArrow(run, docs.schema)

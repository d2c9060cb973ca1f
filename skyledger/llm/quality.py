"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics, compiled to column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fold

FEATURES = ("chars", "words", "word_length", "upper", "digits", "marks", "odd_marks", "accents", "spaces", "lines", "line_words", "bars", "doubled", "ends", "opened")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text that rules look at; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("double")
    rows = docs.select("doc_id", text.alias("t")).withColumns({"chars": F.length("t").cast("double"), "words": count(WORD)})
    share = lambda x: x / F.greatest(F.col("chars"), F.lit(1.0))
    per_word = lambda x: x / F.greatest(F.col("words"), F.lit(1.0))
    spaces = F.length("t") - F.length(F.replace("t", F.lit(" ")))
    rows = rows.withColumns(
        {
            "upper": share(count("[A-Z]")),
            "digits": share(count("[0-9]")),
            "marks": per_word(count(r"[.,;:!?]")),
            "odd_marks": per_word(count(r"[#$%&*<>{}\[\]|~^_=+\\]+")),
            "accents": share(count(r"[^\x00-\x7F]")),
            "spaces": share(spaces),
            "lines": (F.length("t") - F.length(F.replace("t", F.lit("\n"))) + 1).cast("double"),
            "bars": per_word(count(r"\|")),
            "doubled": per_word(count(r"([^\w\s])\1")),
            "ends": per_word(count(r"[.!?](\s|$)")),
            "opened": per_word(count(r"(^|\s)[A-Z]")),
        }
    )
    return rows.withColumns({"word_length": per_word(F.col("chars") - spaces), "line_words": F.col("words") / F.col("lines")}).select("doc_id", *FEATURES)


def grow(x: np.ndarray, residual: np.ndarray, weight: np.ndarray, depth: int, rng: np.random.Generator, leaf: int = 10) -> list[tuple]:
    """Paths of one regression tree by weighted variance gain: conjunctions of (feature, threshold, above)."""
    paths = []

    def split(rows: np.ndarray, path: tuple) -> None:
        if path:
            paths.append(path)
        if len(path) == depth or len(rows) < 2 * leaf:
            return
        best = (1e-9, None)
        total, mass = residual[rows].sum(), weight[rows].sum()
        for f in rng.choice(x.shape[1], max(1, 2 * x.shape[1] // 3), replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, s, w = x[order, f], np.cumsum(residual[order]), np.cumsum(weight[order])
            at = np.flatnonzero(v[1:] > v[:-1])
            at = at[(at + 1 >= leaf) & (len(rows) - at - 1 >= leaf)]
            if len(at):
                gain = s[at] ** 2 / w[at] + (total - s[at]) ** 2 / (mass - w[at]) - total**2 / mass
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (int(f), float((v[at[k]] + v[at[k] + 1]) / 2)))
        if best[1]:
            f, t = best[1]
            split(rows[x[rows, f] <= t], (*path, (f, t, False)))
            split(rows[x[rows, f] > t], (*path, (f, t, True)))

    split(np.arange(len(x)), ())
    return paths


def holds(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, t, above in rule:
        out &= (x[:, f] > t) == above
    return out


class RuleModel:
    """Intercept, linear terms on clipped and scaled statistics, and weighted rules."""

    def __init__(self, bias: float, linear: list[tuple[int, float, float, float, float]], rules: list[tuple[tuple, float]]) -> None:
        self.bias, self.linear, self.rules = bias, linear, rules

    def score(self) -> Column:
        """The model as one column expression over the statistics."""
        z = F.lit(self.bias)
        for f, low, high, middle, weight in self.linear:
            z = z + (F.greatest(F.lit(low), F.least(F.lit(high), F.col(FEATURES[f]))) - middle) * weight
        for rule, weight in self.rules:
            test = F.lit(True)
            for f, t, above in rule:
                test = test & ((F.col(FEATURES[f]) > t) if above else (F.col(FEATURES[f]) <= t))
            z = z + F.when(test, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, penalty: float = 0.002, steps: int = 1500, seed: int = 5) -> RuleModel:
    """Boosted trees give the rules; lasso logistic regression (accelerated proximal gradient) weighs them and the statistics."""
    rng = np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(p / (1 - p))), [], [])
    z, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        rows = rng.random(len(y)) < 0.7
        residual, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        paths = grow(x[rows], residual[rows], weight[rows], depth, rng)
        leaves = [r for r in paths if len(r) == depth or not any(q[: len(r)] == r and len(q) > len(r) for q in paths)]
        for r in leaves:
            inside = holds(r, x)
            z[inside] += 0.3 * residual[inside].sum() / (weight[inside].sum() + 1)
        rules.update(dict.fromkeys(tuple(sorted(r)) for r in paths))
    rules = list(rules)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    clipped = np.clip(x, low, high)
    spread = clipped.std(0)
    linear = (clipped - clipped.mean(0)) / np.where(spread > 0, spread / 0.4, 1)
    a = np.hstack([linear, np.stack([holds(r, x) for r in rules], 1).astype(float)]) if rules else linear
    size = np.abs(a).sum(0).max() and np.linalg.norm(a, 2) ** 2 / (4 * len(y))
    w, v, bias, t = np.zeros(a.shape[1]), np.zeros(a.shape[1]), np.log(y.mean() / (1 - y.mean())), 1.0
    rate = 1 / max(size + 0.25, 1e-9)
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(a @ v + bias))) - y
        new = v - rate * (a.T @ error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        bias -= rate * error.mean()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / after * (new - w), new, after
    kept = [(f, float(low[f]), float(high[f]), float(clipped[:, f].mean()), float(w[f] * 0.4 / spread[f])) for f in range(x.shape[1]) if w[f] and spread[f] > 0]
    return RuleModel(float(bias), kept, [(r, float(c)) for r, c in zip(rules, w[x.shape[1] :], strict=True) if c])


def train(docs: DataFrame, labels: DataFrame, rows: int = 6000, folds: int = 5, held_out_fold: int = 0, **options) -> RuleModel:
    """Fitted on about ``rows`` labelled documents outside the held-out fold, those with the smallest hashes of their ids.

    Where rows repeat an id, those with the smallest hashes of their texts are taken, ``2 * rows`` in all at most."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out_fold))
    n = usable.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) / 1e6
    chosen = usable.where(share < min(1.0, rows / max(n, 1))).groupBy("doc_id").agg(F.max("y").alias("y"))  # about ``rows`` rows: broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    named = texts.select(F.struct("doc_id", "y", F.xxhash64("doc_id", "text").alias("draw")).alias("doc_id"), "text")
    found = statistics(named).select("doc_id.doc_id", "doc_id.y", "doc_id.draw", *FEATURES).orderBy("draw", *FEATURES).limit(2 * rows).collect()
    found.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in found], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in found], float), **options)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_out_fold: int = 0, model: RuleModel | None = None) -> DataFrame:
    """doc_id, held_out, score (0 to 1: label 1 likelier) and predicted of every whole text of ``docs``.

    The compiled model is one column expression over native statistics. Without labels, or with one class alone, the
    score is the smoothed share of that class. Empty and null texts are scored by their zero statistics. A null doc_id
    falls into the fold of the empty string; repeated rows pass through; repeated labels of one id count once, the
    larger; other columns are ignored."""
    model = model if model is not None else train(docs, labels, folds=folds, held_out_fold=held_out_fold)
    rows = statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).withColumn("score", model.score())
    return rows.select("doc_id", (fold(F.col("doc_id"), folds) == held_out_fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

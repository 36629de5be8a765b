"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow trees are grown on bootstrap samples of labelled rows; every path from a root is one
conjunctive rule.  Lasso logistic regression keeps few rules, and those are compiled into one Spark
column expression over the statistics, which are Spark columns too: scoring runs no Python.

Training uses at most SAMPLE labelled rows (those of least hash); all documents are scored, whole.

Cases: null and empty texts have zero statistics and get the score of those; rows with a null id are
scored, never learned from, and not held out; null labels are not learned from; repeated labels and repeated rows of a
document count once, contrary labels each, and different texts of one id each; with labels of one class, or none, the score is the rate of label 1
(0.5 without labels); repeated rows get repeated scores; other columns pass unread, whatever their names, but
for one that has the name asked for as output, which is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, key_bucket, table

SAMPLE = 20_000
TREES, DEPTH, LEAST_LEAF = 60, 3, 20
PENALTY = 0.002
CUT = 0.3
SEED = 7

#: The characters that each share counts.
SHARES = {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": "0123456789",
    "symbols": "#$%&*@^~=+_\\/<>{}[]",
    "shouts": "!?",
    "bars": "|",
    "stops": ".,;:",
    "spaces": " \t",
    "lines": "\n",
}


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text; shares are of its characters, or of its words."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.length(t)
    least = F.greatest(n, F.lit(1))
    words = F.split(t, " ", -1)
    # One pass makes every character of a class its first one; those are counted by what goes with them.
    classed = F.translate(t, "".join(SHARES.values()), "".join(chars[0] * len(chars) for chars in SHARES.values()))
    out = {k: (n - F.length(F.replace(classed, F.lit(chars[0])))) / least for k, chars in SHARES.items()}
    out["log_chars"] = F.log1p(n.cast("double"))
    out["word_chars"] = n / F.size(words)
    out["distinct_words"] = F.size(F.array_distinct(words)) / F.size(words)
    return out


@dataclass(frozen=True)
class Rule:
    conditions: tuple[tuple[str, bool, float], ...]  # statistic, whether it must be above, threshold
    weight: float


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: tuple[Rule, ...]

    def column(self, stats: dict[str, Column]) -> Column:
        """The probability of label 1."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            held = None
            for name, above, value in rule.conditions:
                c = stats[name] > value if above else stats[name] <= value
                held = c if held is None else held & c
            total = total + F.when(held, F.lit(rule.weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, used: tuple = ()) -> list[tuple]:
    """Conditions of every node below the root of one tree: the split of least Gini impurity among
    quantiles of a random third of the statistics, at least three."""
    if depth == 0 or len(y) < 2 * LEAST_LEAF or y.min() == y.max():
        return []
    best = (np.inf, 0, 0.0)
    for f in rng.choice(x.shape[1], max(3, x.shape[1] // 3), replace=False):
        for value in np.unique(np.quantile(x[:, f], rng.uniform(0.02, 0.98, 16))):
            left = x[:, f] <= value
            k = int(left.sum())
            if min(k, len(y) - k) < LEAST_LEAF:
                continue
            p, q = y[left].mean(), y[~left].mean()
            impurity = k * p * (1 - p) + (len(y) - k) * q * (1 - q)
            if impurity < best[0]:
                best = (impurity, int(f), float(value))
    if best[0] == np.inf:
        return []
    _, f, value = best
    out = []
    for above in (False, True):
        path = (*used, (f, above, value))
        own = (x[:, f] > value) == above
        out += [path, *paths(x[own], y[own], rng, depth - 1, path)]
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise mean logistic loss + penalty * |weights|_1 (accelerated proximal gradient)."""
    n, k = r.shape
    v = np.ones(k, r.dtype)
    for _ in range(50):  # the largest singular value, by powers
        v = r.T @ (r @ v)
        v /= max(np.linalg.norm(v), 1e-30)
    step = 4.0 * n / max(1.0, 1.05 * float(np.linalg.norm(r @ v)) ** 2 + n)
    w, b = np.zeros(k), float(np.log(y.mean() / (1 - y.mean())))
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(r @ v.astype(r.dtype) + c, -30, 30))) - y
        w_next = v - step * (r.T @ error.astype(r.dtype)) / n
        w_next = np.sign(w_next) * np.maximum(np.abs(w_next) - step * penalty, 0)
        b_next = c - step * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return b, w


def fit(names: list[str], x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Ensemble:
    if not len(y):
        return Ensemble(0.0, ())
    if y.min() == y.max():
        rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        return Ensemble(float(np.log(rate / (1 - rate))), ())
    rng, found = np.random.default_rng(seed), {}
    for _ in range(TREES):
        rows = rng.integers(0, len(y), min(len(y), 4000))
        for path in paths(x[rows], y[rows], rng, DEPTH):
            held = np.all([(x[:, f] > v) == above for f, above, v in path], axis=0)
            if 0 < held.sum() < len(y):
                found.setdefault(held.tobytes(), (path, held))  # rules that hold for the same rows are one
    if not found:
        return fit(names, x, np.full(len(y), y.mean()))
    held = np.stack([h for _, h in found.values()], 1)
    share = held.mean(0)
    spread = np.sqrt(share * (1 - share))
    intercept, weights = lasso_logistic(held / spread.astype(np.float32), y, PENALTY)
    weights = weights / spread
    rules = [
        Rule(tuple((names[f], above, v) for f, above, v in path), float(w))
        for (path, _), w in zip(found.values(), weights, strict=True)
        if w
    ]
    return Ensemble(float(intercept), tuple(sorted(rules, key=lambda q: -abs(q.weight))))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Ensemble:
    """Fit on the sample labelled rows of least hash; only their statistics reach the driver."""
    rows = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("double").alias("y")).where("id is not null and y in (0, 1)").distinct()
    rows = rows.orderBy(F.xxhash64("id", F.lit(SEED)), "id", "y").limit(sample)
    stats = statistics(F.col("text"))
    # The sample's size bounds what is broadcast, and what an id with many rows sends.
    picked = docs.select(F.col("doc_id").alias("own"), "text").join(F.broadcast(rows), F.col("own") == F.col("id"))
    picked = picked.select("id", "y", *(c.cast("double").alias(k) for k, c in stats.items())).distinct()
    got = picked.orderBy(F.xxhash64("id", F.lit(SEED)), "id", "y", *stats).limit(sample).toPandas().sort_values(["id", "y", *stats], kind="stable")
    return fit(list(stats), got[list(stats)].to_numpy(float), got["y"].to_numpy(float))


def score(docs: DataFrame, ensemble: Ensemble, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability of label 1 in the column out."""
    stats = statistics(F.col(text))
    names = {k: free_name(docs, f"statistic_{k}") for k in stats}
    named = docs.withColumns({names[k]: c for k, c in stats.items()})
    return named.withColumn(out, ensemble.column({k: F.col(names[k]) for k in stats})).drop(*names.values())


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(key_bucket("doc_id", 5) == 0, F.lit(False))
    ensemble = learn(docs, table(spark, sf_dir, "labels").where(key_bucket("doc_id", 5) != 0))
    out = score(docs, ensemble).select("doc_id", held_out.alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))

"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are boosted on a bounded sample of labelled rows (``SAMPLE`` rows,
the smallest hashes of doc_id).  Every path from a root is a conjunctive rule;
a lasso logistic regression over the rules leaves few with a weight.  The rules
that remain are compiled to one Spark column expression, so scoring is a
projection over the statistics.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import stats
from ledgerlake.llm.scratch import Scratch, smallest

SAMPLE = 12_000
TREES = 30
DEPTH = 3
RATE = 0.3
PENALTY = 0.002
STEPS = 300
CUTS = 32
SEED = 11

#: A rule: (feature, True for "above", cut) tests that all hold.
Rule = tuple[tuple[str, bool, float], ...]


def _tree_rules(x: np.ndarray, residual: np.ndarray, names: list[str], cuts: list[np.ndarray]
                ) -> tuple[list[Rule], list[tuple[Rule, float]]]:
    """The rules of one least-squares tree, and its leaves with their values."""
    rules: list[Rule] = []
    leaves: list[tuple[Rule, float]] = []

    def split(rows: np.ndarray, rule: Rule, depth: int) -> None:
        r = residual[rows]
        if depth == DEPTH or len(rows) < 20:
            leaves.append((rule, float(r.mean())))
            return
        best = (1e-9, None, None)
        base = r.sum() ** 2 / len(r)
        for f, values in enumerate(cuts):
            if not len(values):
                continue
            place = np.searchsorted(values, x[rows, f], "left")  # rows with x <= cut k are those with place <= k
            n = np.cumsum(np.bincount(place, minlength=len(values) + 1))[:-1]
            s = np.cumsum(np.bincount(place, weights=r, minlength=len(values) + 1))[:-1]
            m = len(r) - n
            ok = (n >= 5) & (m >= 5)
            gain = np.where(ok, s ** 2 / np.maximum(n, 1) + (r.sum() - s) ** 2 / np.maximum(m, 1) - base, 0.0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, float(values[k]))
        if best[1] is None:
            leaves.append((rule, float(r.mean())))
            return
        above = x[rows, best[1]] > best[2]
        for side in (False, True):
            path = (*rule, (names[best[1]], side, best[2]))
            rules.append(path)
            split(rows[above == side], path, depth + 1)

    split(np.arange(len(x)), (), 0)
    return rules, leaves


def _fitted(leaves: list[tuple[Rule, float]], x: np.ndarray, names: list[str]) -> np.ndarray:
    """The tree's value for each row: leaves cover all rows once."""
    out = np.zeros(len(x))
    for rule, value in leaves:
        out[holds(rule, x, names)] = value
    return out


def holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, above, cut in rule:
        column = x[:, names.index(name)]
        out &= (column > cut) if above else (column <= cut)
    return out


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(share / (1 - share)))
    if y.min() == y.max():
        return float(score[0]), []
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    cuts = [c[c < column.max()] for c, column in zip(cuts, x.T, strict=True)]
    rng = np.random.default_rng(SEED)
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        residual = y - 1 / (1 + np.exp(-score))
        part = rng.random(len(y)) < 0.5
        if part.sum() < 40:
            part[:] = True
        rules, leaves = _tree_rules(x[part], residual[part], names, cuts)
        if not rules:
            break
        # the tree whose rules are kept moves the scores of all rows
        score += RATE * 4 * _fitted(leaves, x, names)
        found.update(dict.fromkeys(rules))
    rules = list(found)
    if not rules:
        return float(score[0]), []
    a = np.stack([holds(r, x, names) for r in rules], axis=1).astype(np.float32)
    centre, scale = a.mean(axis=0), np.maximum(a.std(axis=0), 0.05)
    a = (a - centre) / scale
    # accelerated proximal gradient; the bound on the curvature comes from power iterations
    v = np.ones(a.shape[1], dtype=np.float32)
    for _ in range(20):
        v = a.T @ (a @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1.0 / max(0.25 * float(np.linalg.norm(a @ v) ** 2) / len(y) * 1.1, 1e-9)
    w = z = np.zeros(a.shape[1])
    b, t = float(np.log(share / (1 - share))), 1.0
    zb = b
    for _ in range(STEPS):
        g = 1 / (1 + np.exp(-(a @ z.astype(np.float32) + zb))) - y
        new = z - step * (a.T @ g.astype(np.float32)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0.0)
        nb = zb - 4 * g.mean() * 0.5
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / nt * (new - w), nb
        w, b, t = new, nb, nt
    weights = w / scale
    return float(b - (weights * centre).sum()), [(r, float(k)) for r, k in zip(rules, weights, strict=True) if abs(k) > 1e-6]


def compiled(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The probability of label 1 as a column expression over the features' names."""
    total = F.lit(intercept)
    for rule, weight in rules:
        test = F.lit(True)
        for name, above, cut in rule:
            test = test & ((F.col(name) > cut) if above else (F.col(name) <= cut))
        total = total + F.when(test, F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def learn(table: DataFrame, labels: DataFrame, train: Column | None = None) -> Column:
    """The score as an expression over the statistics, from the stats.COUNTS of a table with doc_id and labels (doc_id, quality, ..)."""
    rates = stats.features()
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where("doc_id is not null and quality in (0, 1)")
    if train is not None:
        marks = marks.where(train)
    sample = table.join(marks, "doc_id").select(*[c.alias(n) for n, c in rates.items()], "quality", F.xxhash64("doc_id").alias("h"), "doc_id")
    drawn = smallest(sample, SAMPLE, "h", "doc_id", "quality", *rates)  # SAMPLE rows of a few numbers at most
    rows = np.array([[r[c] for c in (*rates, "quality")] for r in drawn], dtype=float)
    return compiled(*fit(rows[:, :-1], rows[:, -1], list(rates))) if len(rows) else F.lit(1.0)


def scored(table: DataFrame, score: Column) -> DataFrame:
    """The table with its statistics and score."""
    return table.select("*", *[c.alias(n) for n, c in stats.features().items()]).withColumn("score", score)


def train_scores(spark: SparkSession, documents: DataFrame, labels: DataFrame,
                 train: Column | None = None, threshold: float = 0.7) -> DataFrame:
    """documents (doc_id, text, ..), labels (doc_id, quality, ..) -> doc_id, stats.COUNTS, score, predicted.

    One row for each input row.  ``train`` (over doc_id) names the labelled rows to learn from; all
    if None.  Null and empty texts are scored by their counts of 0.  Labels with
    a null doc_id or quality are ignored.  With no usable labels every row scores 1:
    nothing is known against it.  Other columns are ignored.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = Scratch(spark, "rulefit").table(stats.with_counts(documents, "doc_id"))
    return scored(table, learn(table, labels, train)).select(
        "doc_id", *stats.COUNTS, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def accepted(spark: SparkSession, documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    score = learn(Scratch(spark, "rulefit").table(stats.with_counts(rows, "doc_id")), labels)
    kept = [f"__kept_{i}" for i in range(len(documents.columns))]  # names that no statistic has
    held = documents.toDF(*kept).withColumn("text", F.col(kept[documents.columns.index("text")]))
    return scored(stats.with_counts(held, *kept), score).where(F.col("score") >= threshold).select(*kept).toDF(*documents.columns)

"""Quality rules: hard limits, then an isolation forest over rule statistics.

Every text gets the counts of ``stats`` and from them rates.  A rule statistic is how far a
rate lies outside the range of good rows (``TAIL`` of them at either end), on a
log scale, 0 inside.  A forest of random splits is grown on
a bounded sample of labelled rows (``SAMPLE`` of each label, the smallest hashes
of doc_id).  Each tree sees good rows and a share ``RARE`` of bad ones, so that
statistics that never vary among good rows can be split on while bad rows stay
few: a document that few splits isolate is unlike good text.  The limit on the anomaly score comes from a histogram of *all* labelled
rows that pass the hard limits: of the limits that lose at most ``MAX_LOSS`` of the good rows, the one with
the best difference of hit rates.  Without labelled rows of both kinds the method
keeps everything and only the hard limits act.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import stats
from ledgerlake.llm.scratch import Scratch, smallest

SAMPLE = 10_000
RARE = 0.06
TREES = 100
TREE_ROWS = 256
MAX_LOSS = 0.005
BINS = 2000
#: Statistics of length alone: short and long texts are rare, not bad.
LENGTHS = ("log_words", "line_words")
#: Share of good rows beyond the usual range of a statistic, at either end.
TAIL = 0.002
#: The hard limits.
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
SEED = 7

_DEPTH = 8


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe))


def grow(good: np.ndarray, bad: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """TREES trees as arrays in heap order: feature (-1: leaf), split value, path length at a leaf; and the normaliser."""
    rng = np.random.default_rng(seed)
    size = 2 ** (_DEPTH + 1) - 1
    feature = np.full((TREES, size), -1, dtype=np.int64)
    value, length = np.zeros((TREES, size)), np.zeros((TREES, size))
    few = min(int(TREE_ROWS * RARE), len(bad))
    many = min(TREE_ROWS - few, len(good))
    rows_each = few + many
    for t in range(TREES):
        start = np.concatenate([good[rng.choice(len(good), many, replace=False)], bad[rng.choice(len(bad), few, replace=False)]])
        todo = [(0, 0, start)]
        while todo:
            node, depth, rows = todo.pop()
            spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
            if depth == _DEPTH or not len(spread):
                length[t, node] = depth + float(_mean_path(len(rows)))
                continue
            f = int(rng.choice(spread))
            # a split at the minimum would leave one side empty
            v = float(rng.uniform(rows[:, f].min(), rows[:, f].max()))
            left = rows[:, f] <= v
            feature[t, node], value[t, node] = f, v
            todo += [(2 * node + 1, depth + 1, rows[left]), (2 * node + 2, depth + 1, rows[~left])]
    return feature, value, length, float(_mean_path(rows_each)) or 1.0


def anomaly(x: np.ndarray, forest: tuple[np.ndarray, np.ndarray, np.ndarray, float]) -> np.ndarray:
    """2 ** (- mean path length / normaliser): near 1 for rows that few splits isolate."""
    feature, value, length, norm = forest
    total, every = np.zeros(len(x)), np.arange(len(x))
    for t in range(len(feature)):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(_DEPTH):
            f = feature[t][node]
            node = np.where(f < 0, node, 2 * node + 1 + (x[every, f] > value[t][node]))
        total += length[t][node]
    return 2.0 ** (-total / len(feature) / norm)


def _scorer(forest, n_features: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.columns[n_features:]
            x = np.stack([np.asarray(c, dtype=float) for c in batch.columns[:n_features]], axis=1)
            yield pa.RecordBatch.from_arrays([*rest, pa.array(anomaly(x, forest))], names=[*batch.schema.names[n_features:], "anomaly"])
    return run


def usual(rates: dict[str, Column], good: np.ndarray) -> dict[str, Column]:
    """Rule statistics: the distance of each rate from the usual range of good rows, above and below."""
    out = {}
    for i, (name, rate) in enumerate(rates.items()):
        low, mid, high = (float(q) for q in np.quantile(good[:, i], [TAIL, 0.5, 1 - TAIL]))
        beyond = lambda gap, width: F.log1p(F.greatest(gap, F.lit(0.0)) / max(width, 0.01))
        out[f"{name}_high"] = beyond(rate - high, high - mid)
        out[f"{name}_low"] = beyond(low - rate, mid - low)
    return out


def _points(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """``usual`` for sampled rows."""
    low, mid, high = np.quantile(good, [TAIL, 0.5, 1 - TAIL], axis=0)
    above = np.log1p(np.maximum(x - high, 0) / np.maximum(high - mid, 0.01))
    below = np.log1p(np.maximum(low - x, 0) / np.maximum(mid - low, 0.01))
    return np.stack([above, below], axis=2).reshape(len(x), -1)


def _limit(scored: DataFrame, max_loss: float) -> float:
    """The calibrated limit on the anomaly score; above 1 if there is nothing to calibrate on."""
    bins = scored.groupBy(F.floor(F.col("anomaly") * BINS).alias("bin")).agg(
        F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count(F.when(F.col("quality") == 0, 1)).alias("bad"))
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for r in bins.collect():  # BINS + 1 rows at most
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    if not good.sum() or not bad.sum():
        return 2.0
    lost = np.cumsum(good[::-1])[::-1] / good.sum()
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= max_loss, caught - lost, -1.0)
    return int(gain.argmax()) / BINS


def judge(spark: SparkSession, documents: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """documents (doc_id, text, ..), labels (doc_id, quality, ..) -> doc_id, stats.COUNTS, base_failed, anomaly, kept.

    One row for each input row.  Null and empty texts have counts of 0 and fail
    the base rule (fewer than 10 words).  Labels with a null doc_id or quality
    are ignored; a doc_id labelled more than once counts as often.  Ties of the
    sample's hash are broken by doc_id.  Other columns are ignored.
    """
    scratch = Scratch(spark, "quality-rules")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = scratch.table(stats.with_counts(documents, "doc_id"))
    rates = {n: c for n, c in stats.features().items() if n not in LENGTHS}
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where("doc_id is not null and quality is not null")
    labelled = scratch.table(table.join(marks, "doc_id").where(f"not ({BASE_FAILED})"))
    samples = []
    for mark in (1, 0):
        rows = labelled.where(F.col("quality") == mark).select(*[c.alias(n) for n, c in rates.items()], F.xxhash64("doc_id").alias("h"), "doc_id")
        drawn = smallest(rows, SAMPLE, "h", "doc_id", *rates)  # SAMPLE rows of a few numbers at most
        samples.append(np.array([[r[c] for c in rates] for r in drawn], dtype=float).reshape(-1, len(rates)))
    base = table.withColumn("base_failed", F.expr(BASE_FAILED))
    if not len(samples[0]) or not len(samples[1]):
        return base.withColumn("anomaly", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    rules = usual(rates, samples[0])
    points = [_points(x, samples[0]) for x in samples]
    run = _scorer(grow(*points), len(rules))
    limit = _limit(labelled.select(*[c.alias(n) for n, c in rules.items()], "quality").mapInArrow(run, "quality int, anomaly double"), max_loss)
    fields = ["doc_id", *stats.COUNTS, "base_failed"]
    schema = "doc_id long, " + "".join(f"{c} long, " for c in stats.COUNTS) + "base_failed boolean, anomaly double"
    scored = base.select(*[c.alias(n) for n, c in rules.items()], *fields).mapInArrow(run, schema)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))

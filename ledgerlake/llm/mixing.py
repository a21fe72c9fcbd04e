"""Mixing to target weights with soft membership of domains.

Domains are label combinations: clean, toxic and junk text.  A naive Bayes
classifier over binned statistics of the text, counted on all labelled rows,
gives every document a posterior over the domains.  Words that mark toxic text are
learned from a bounded sample of labelled rows (``SAMPLE`` of each label).  Document rates are then fitted by
projected-gradient least squares: a step is one distributed sum of the expected tokens of each domain, the residuals
are weighed by the inverse Gram matrix over all rows (so a step of length 1 descends), every rate moves against the gradient,
which is its row's posterior times those residuals, and is projected onto the allowed range.  The rate of a row is
the fold of the steps so far over its posterior, so only three numbers a step pass through the driver.  Documents
of one code of binned statistics have one posterior and one rate, so the sums run over
codes, of which there are at most BINS ** 4 whatever the input, and a broadcast of that
bounded table brings the rates to the documents: no text is shuffled.

Two goals are fitted this way.  ``rates`` meets shares of the expected tokens with rates r >= 0, which may exceed 1.
``mixed`` repeats no document: its rates lie in [0, 1], and it
thins each domain to its share beside the first one (clean text), so a target acts as a ceiling; a domain that holds
less than its share stays as it is, and what it lacks falls to the others (``Fit.targets`` states the shares that follow).
DataFrame functions only.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import Scratch

DOMAINS = ("clean", "toxic", "junk")
#: Shares of all expected tokens.
TARGETS = {"clean": 0.87, "toxic": 0.08, "junk": 0.05}
SAMPLE = 2000
MARKERS = 16
STEPS = 100
TOLERANCE = 1e-3
BINS = 16
#: Evidence of several statistics of one text is not independent: log-likelihoods are added at this weight.
TEMPER = 0.7

_BREAK = "[\\x20\\x09-\\x0D.,;:!?]+"
_PRE = "__mix_"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk")


def _markers(documents: DataFrame, marks: DataFrame) -> list[str]:
    """Words in at least 1 of 20 sampled toxic texts, and there at least four times as often as in sampled others."""
    sample = None
    for toxic in (True, False):
        own = (F.col("domain") == "toxic") == F.lit(toxic)
        part = marks.where(own).select("doc_id", F.lit(toxic).alias("bad")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        sample = part if sample is None else sample.union(part)
    # 2 x SAMPLE rows of an id at most
    texts = documents.join(F.broadcast(sample), "doc_id").select("bad", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    size = {r["bad"]: r["n"] for r in sample.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    if not size.get(True) or not size.get(False):
        return []
    share = texts.groupBy("word").agg((F.count(F.when(F.col("bad"), 1)) / size[True]).alias("inside"),
                                      (F.count(F.when(~F.col("bad"), 1)) / size[False]).alias("outside"))
    found = share.where("inside >= 0.05 and inside >= 4 * outside") \
        .orderBy(F.desc(F.col("inside") - F.col("outside")), "word").limit(MARKERS)
    return [r["word"] for r in found.select("word").collect()]


def _measured(documents: DataFrame, markers: list[str]) -> DataFrame:
    """The documents with their token number and a code of their binned statistics."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = documents.withColumn(f"{_PRE}distinct", F.array_distinct(_words(text))) \
        .withColumn(f"{_PRE}tokens", F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"))
    tokens = F.greatest(F.col(f"{_PRE}tokens"), F.lit(1))
    fine = lambda rate: F.least(F.floor(F.log2(1 + 64 * rate) * 1.5), F.lit(BINS - 1)).cast("int")
    marks = F.size(F.array_intersect(f"{_PRE}distinct", F.array(*map(F.lit, markers)))) if markers else F.lit(0)
    bins = [
        fine(F.regexp_count(text, F.lit("[#*$%&|<>]")) / tokens),
        fine(F.regexp_count(text, F.lit("[A-Z]")) / tokens),
        F.least(F.floor(F.size(f"{_PRE}distinct") / tokens * BINS), F.lit(BINS - 1)).cast("int"),
        F.least(marks, F.lit(BINS - 1)),
    ]
    code = sum((x * BINS ** k for k, x in enumerate(bins)), F.lit(0))
    return out.withColumn(f"{_PRE}code", code).drop(f"{_PRE}distinct")


_STATISTICS = 4


def _bins() -> Column:
    """The bins of a code."""
    return F.array(*[F.expr(f"int({_PRE}code div {BINS ** k} % {BINS})") for k in range(_STATISTICS)])


def _posterior(counts: list) -> Column:
    """Posterior array over DOMAINS from counts (domain, statistic, bin, n) of the labelled rows."""
    table = {(r["domain"], r["statistic"], r["bin"]): r["n"] for r in counts}
    total = {d: sum(n for (x, s, _), n in table.items() if x == d and s == 0) for d in DOMAINS}
    known = sum(total.values())
    logs = []
    for d in DOMAINS:
        score = F.lit(math.log((total[d] + 1) / (known + len(DOMAINS))))
        for s in range(_STATISTICS):
            row = [TEMPER * math.log((table.get((d, s, b), 0) + 0.5) / (total[d] + 0.5 * BINS)) for b in range(BINS)]
            score = score + F.element_at(F.array(*map(F.lit, row)), F.element_at(_bins(), s + 1) + 1)
        logs.append(score)
    logs = F.array(*logs)
    powers = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


@dataclass
class Fit:
    """Documents with their code and tokens; codes with posterior and rate; marker words; and what the rates come to."""
    measured: DataFrame
    groups: DataFrame
    markers: list[str]
    #: expected tokens of each domain before and after the rates
    held: dict[str, float]
    got: dict[str, float]
    #: shares of the expected tokens that were aimed at, and by what part of its goal each domain misses it
    targets: dict[str, float]
    missed: dict[str, float]


def _rate(steps: list[np.ndarray], constraints: np.ndarray, top: float | None) -> Column:
    """The rate of a code: 1, moved against each step's residuals and projected, step by step."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in constraints.T @ step]) for step in steps])

    def moved(rate: Column, move: Column) -> Column:
        new = rate - sum((F.element_at(f"{_PRE}p", k + 1) * move[k] for k in range(len(DOMAINS))), F.lit(0.0))
        return F.greatest(F.lit(0.0), new if top is None else F.least(F.lit(top), new))
    return F.aggregate(moves, F.lit(1.0), moved)


def _descend(groups: DataFrame, constraints: np.ndarray, goal: np.ndarray, room: np.ndarray, top: float | None,
             at_most: bool) -> tuple[Column, np.ndarray]:
    """Rates by projected gradient from 1 so that constraints @ expected tokens = goal (or <= goal), and the expected tokens then.

    Stops when each residual is within TOLERANCE of ``room`` (or when steps no longer change it)."""
    size = len(DOMAINS)
    p = [F.element_at(f"{_PRE}p", k + 1) for k in range(size)]
    gram = np.array([float(x or 0.0) for x in groups.agg(*[
        F.sum(F.col("tokens") * p[i] * p[j]) for i in range(size) for j in range(size)]).first()]).reshape(size, size)
    gram = constraints @ gram @ constraints.T
    if at_most:  # ceilings act one by one: a diagonal metric keeps them apart
        weight = np.diag(1.0 / np.maximum(len(goal) * np.diag(gram), 1e-9))
    else:
        weight = np.linalg.inv(gram + 1e-9 * max(np.trace(gram), 1.0) * np.eye(len(goal)))
    steps: list[np.ndarray] = []
    while True:
        rate = _rate(steps, constraints, top)
        sums = groups.select("tokens", *[x.alias(f"p{k}") for k, x in enumerate(p)], rate.alias("r")) \
            .agg(*[F.sum(F.col("tokens") * F.col("r") * F.col(f"p{k}")).alias(f"s{k}") for k in range(size)])
        got = np.array([float(x or 0.0) for x in sums.first()])
        miss = constraints @ got - goal
        if at_most:
            miss = np.maximum(miss, 0.0)
        if (np.abs(miss) <= TOLERANCE * room).all() or len(steps) == STEPS:
            return rate, got
        steps.append(weight @ miss)


def _learned(spark: SparkSession, documents: DataFrame, labels: DataFrame, scratch: Scratch, *keep: str) -> tuple[DataFrame, DataFrame, list[str], np.ndarray]:
    """The measured documents, their codes with tokens and posterior, the marker words, and the expected tokens of each domain."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), _domain().alias("domain")).where("doc_id is not null and domain is not null")
    markers = _markers(rows, marks)
    measured = scratch.table(_measured(documents, markers).select(F.col("doc_id").cast("long").alias("doc_id"), *keep, f"{_PRE}tokens", f"{_PRE}code"))
    counts = measured.join(marks, "doc_id").select("domain", F.posexplode(_bins()).alias("statistic", "bin")) \
        .groupBy("domain", "statistic", "bin").agg(F.count("*").alias("n")).collect()  # domains x statistics x bins
    # rows of one code have one posterior, and so one rate: at most BINS ** 4 codes whatever the input
    groups = scratch.table(measured.groupBy(f"{_PRE}code").agg(F.sum(f"{_PRE}tokens").alias("tokens"))
                           .repartition(1).withColumn(f"{_PRE}p", _posterior(counts)))
    sums = [F.sum(F.col("tokens") * F.element_at(f"{_PRE}p", k + 1)) for k in range(len(DOMAINS))]
    return measured, groups, markers, np.array([float(x or 0.0) for x in groups.agg(*sums).first()])


def _named(x: np.ndarray) -> dict[str, float]:
    return {d: float(v) for d, v in zip(DOMAINS, x, strict=True)}


def _share(x: np.ndarray) -> np.ndarray:
    return x / x.sum() if x.sum() > 0 else np.zeros(len(x))


def fit(spark: SparkSession, documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
        *keep: str, thin: bool = False) -> Fit:
    """Learn posteriors from labels (doc_id, quality, toxic, ..) and rates for the documents (doc_id, text, ..).

    The targets are shares of the expected tokens, scaled so that the first domain keeps the total of its
    tokens (if its share is 0, the largest).  Without ``thin`` rates are >= 0 and every target is aimed at; with ``thin`` they lie in [0, 1],
    and the targets of the other domains are ceilings beside what is left of the first.
    A target that no rates meet is missed by what ``Fit.missed`` says, and named in a warning.  Labels with a null
    doc_id or without a domain are ignored.  Without labels the posterior is uniform; without tokens all rates are 1.
    """
    targets, scratch = targets or TARGETS, Scratch(spark, "mixing")
    share = np.array([targets.get(d, 0.0) for d in DOMAINS])
    measured, groups, markers, held = _learned(spark, documents, labels, scratch, *keep)
    base = 0 if share[0] > 0 else int(share.argmax())
    if held.sum() <= 0 or share[base] <= 0:
        rate, got, aim, miss = F.lit(1.0), held, _share(held), np.zeros(len(DOMAINS))
    elif thin:
        others = [k for k in range(len(DOMAINS)) if k != base]
        ceiling = np.zeros((len(others), len(DOMAINS)))
        for i, k in enumerate(others):
            ceiling[i, k], ceiling[i, base] = 1.0, -share[k] / share[base]
        room = np.maximum(share[others] / share[base] * held[base], TOLERANCE * held.sum())
        rate, got = _descend(groups, ceiling, np.zeros(len(others)), room, 1.0, True)
        aim = np.array([got[k] if k == base else min(got[k], share[k] / share[base] * got[base]) for k in range(len(DOMAINS))])
        miss, aim = (got - aim) / np.maximum(aim, TOLERANCE * max(got.sum(), 1.0)), _share(aim)
    else:
        goal = share / share[base] * held[base]
        room = np.maximum(goal, TOLERANCE * held.sum())
        rate, got = _descend(groups, np.eye(len(DOMAINS)), goal, room, None, False)
        miss, aim = (got - goal) / room, _share(goal)
    if (np.abs(miss) > 10 * TOLERANCE).any():
        warnings.warn(f"mixing: targets not met, excess of each domain as a share of its goal: {_named(miss)}", stacklevel=2)
    rated = scratch.table(groups.select(f"{_PRE}code", f"{_PRE}p", rate.alias(f"{_PRE}rate")))
    return Fit(measured, rated, markers, _named(held), _named(got), _named(aim), _named(miss))


def rates(spark: SparkSession, documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, thin: bool = False) -> DataFrame:
    """documents (doc_id, text, source, ..) -> doc_id, source, n_tokens, p_clean, p_toxic, p_junk, rate.

    One row for each input row; null and empty texts have no tokens and the posterior of an empty text.
    Rows with a null doc_id and repeated rows get rates like others.  Other columns are ignored.
    """
    found = fit(spark, documents.select("doc_id", "source", "text"), labels, targets, "source", thin=thin)
    out = found.measured.join(F.broadcast(found.groups), f"{_PRE}code")
    return out.select("doc_id", "source", F.col(f"{_PRE}tokens").alias("n_tokens"),
                      *[F.element_at(f"{_PRE}p", k + 1).alias(f"p_{d}") for k, d in enumerate(DOMAINS)], F.col(f"{_PRE}rate").alias("rate"))


def mixed(spark: SparkSession, documents: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents thinned to the targets, all columns kept: a row stays with the probability of its rate in [0, 1].

    No row is repeated, since copies went before.  The draw is a hash of doc_id and text, so equal rows stay or go
    together, and rows with a null doc_id by their text.
    """
    found = fit(spark, documents.select("doc_id", "text"), labels, targets, thin=True)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    out = _measured(documents, found.markers).join(F.broadcast(found.groups), f"{_PRE}code")
    return out.where(F.col(f"{_PRE}rate") > draw).select(*[F.col(f"`{c}`") for c in documents.columns])

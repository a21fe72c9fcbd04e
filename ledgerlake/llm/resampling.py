"""Importance resampling towards a target distribution, by overlapped regular expressions.

Texts become hashed n-gram counts: A-Z are lower-cased, every run of separators (ASCII other
than letters and digits) collapses to one blank, and for each n one pattern with boundary
lookarounds is run with ``overlapped=True``.  Each match is the span of one n-gram, whose bytes go
straight to CRC-32; neither a list of words nor a joined n-gram is built.  A bucket's gain is the log
ratio of its smoothed share in the target and in the documents; a document's weight is
the mean gain of its features, and adding Gumbel noise drawn from a hash of doc_id turns "the
highest scores" into a sample without replacement.

A text is scanned once: its counts by bucket (``buckets`` at most) are written to the shared
folder, and the rest reads only those.  To the driver go the totals by bucket
(``buckets`` rows), rows a score (scores are whole thousandths between about -70,000 and 70,000, whatever
the input) and rows a partition.  Ranks come from a sort by ranges, so no task holds all drawn rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import textblocks as tb
from ledgerlake.llm.scratch import Scratch

ORDERS = (1, 1)
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10


def _folding() -> bytes:
    """A-Z lower-cased, separators as blanks, letters, digits and bytes beyond ASCII as they are."""
    table = bytearray(range(256))
    for c in range(128):
        if not chr(c).isalnum():
            table[c] = 0x20
        elif chr(c).isupper():
            table[c] += 32
    return bytes(table)


FOLDED = _folding()


def span_pattern(n: int) -> regex.Pattern:
    """n words with one blank between them; run with ``overlapped=True`` it meets every run of n words once."""
    return regex.compile(rb"(?<![^ ])" + rb" ".join([rb"[^ ]++"] * n) + rb"(?![^ ])")


def collapsed(text: bytes) -> bytes:
    """Lower-cased words with one blank between them."""
    return b" ".join(text.translate(FOLDED).split())


def feature_buckets(line: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of each feature of a collapsed line."""
    crc = zlib.crc32
    parts = [np.fromiter((crc(line[slice(*m.span())]) for m in p.finditer(line, overlapped=True)), dtype=np.uint32) for p in patterns]
    return (np.concatenate(parts) % np.uint32(buckets)).astype(np.int32)


def _scanner(orders: tuple[int, int], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [span_pattern(n) for n in range(orders[0], orders[1] + 1)]
        for batch in batches:
            for lo, hi, buf, off in tb.text_blocks(batch.column(0)):
                raw, words, sizes, found, times = buf.tobytes(), [], [0], [], []
                for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                    line = collapsed(raw[a:b])
                    words.append(line.count(b" ") + 1 if line else 0)
                    bucket, count = np.unique(feature_buckets(line, patterns, buckets), return_counts=True)
                    found.append(bucket)
                    times.append(count)
                    sizes.append(len(bucket))
                ends = pa.array(np.cumsum(sizes), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[1:]), pa.array(words, pa.int64()),
                     pa.array([int(t.sum()) for t in times], pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found), pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times), pa.int64()))],
                    names=[*batch.schema.names[1:], "n_words", "n_features", "bucket", "times"])
    return run


def scan(rows: DataFrame, orders: tuple[int, int], buckets: int, *keep: str) -> DataFrame:
    """The columns in keep, n_words, n_features and the counts by bucket of each row's text (null: none)."""
    kept = rows.select(*keep)
    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept.schema)
    return rows.select(F.col("text").cast("string").alias("text"), *keep).mapInArrow(
        _scanner(orders, buckets), fields + "n_words long, n_features long, bucket array<int>, times array<long>")


def totals(scanned: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows."""
    out = np.zeros(buckets, dtype=np.int64)
    rows = scanned.select(F.inline(F.arrays_zip("bucket", "times"))).groupBy("bucket").agg(F.sum("times").alias("n"))
    for r in rows.collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares."""
    n = len(target)
    t, s = target.astype(float), source.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weigher(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, times, features = batch.column(0), batch.column(1), np.asarray(batch.column(2))
            value = gain[np.asarray(bucket.flatten())] * np.asarray(times.flatten())
            sums = np.r_[0, np.cumsum(value)]
            ends = np.cumsum(np.r_[0, np.asarray(bucket.value_lengths().fill_null(0))])
            mean = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(mean)], names=[*batch.schema.names[2:], "weight"])
    return run


def ranked(spark: SparkSession, rows: DataFrame, score: str, scratch: Scratch, *ties: str) -> DataFrame:
    """The rows with their rank by descending score (ties: ascending columns): sorted by ranges, then numbered on from the ranges before."""
    order = [F.col(score).desc(), *[F.col(c).asc() for c in ties]]
    placed = scratch.table(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row a partition
    before, starts = 0, []
    for p in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(p, 0)
    if not starts:
        return placed.withColumn("rank", F.lit(None).cast("long")).drop("at")
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), (part + 1).cast("int"))
    return placed.withColumn("rank", first + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("at")


def resample(spark: SparkSession, documents: DataFrame, target: DataFrame, orders: tuple[int, int] = ORDERS, buckets: int = BUCKETS,
             seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """documents (doc_id, text, ..), target (text, ..) -> doc_id, n_words, n_features, weight, score, rank (all long).

    One row for each input row.  Of the N rows with ``min_words`` words and a doc_id, the floor(percent * N / 100) highest scores are
    drawn and ranked from 1; rank is null for the others.  Ties go to the smaller doc_id; repeated rows share a score and
    get ranks of their own.  Null and empty texts have no features and a weight of 0.
    A row with a null doc_id counts as a document for the buckets, but has a null score and is never drawn.
    An empty target or an empty table leaves smoothed shares only.  Other columns are ignored.
    """
    scratch = Scratch(spark, "resampling")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = scratch.table(scan(rows, orders, buckets, "doc_id"))
    gain = gains(totals(scan(target.select("text"), orders, buckets), buckets), totals(scanned, buckets))
    weighed = scanned.select("bucket", "times", "n_features", "n_words", "doc_id").mapInArrow(
        _weigher(gain), "n_features long, n_words long, doc_id long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = scratch.table(weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score")))
    may = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    by_score = sorted(((r["score"], r["n"]) for r in scored.where(may).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    drawn = percent * sum(n for _, n in by_score) // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    reached, least = 0, None
    for least, n in by_score:
        reached += n
        if reached >= drawn:
            break
    near = F.coalesce(may & (F.col("score") >= F.lit(least)), F.lit(False))
    top = ranked(spark, scored.where(near), "score", scratch, "doc_id", "n_words", "n_features")
    top = top.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return top.unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))

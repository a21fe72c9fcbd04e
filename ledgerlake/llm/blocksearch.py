"""Exact top-k by inner product, with block-at-a-time pruning.

Vectors are quantised to whole numbers and packed, in the order of the table, into blocks of ``BLOCK`` rows:
a forward index (the matrix) and, for each term (component), its maximum and minimum in the block.
For a query, the sum over terms of the larger of query x maximum and query x minimum bounds
every score in a block.  Blocks are taken in the order of that bound, each query in its own order; a block is scored
through its forward index, and a query is done when the bound of its next block falls below its k-th score.

The work is dealt in cells: a shard of ``SHARD`` blocks against a chunk of ``CHUNK`` blocks of queries,
so a task holds two bounded matrices whatever the input, and equal or frequent vectors make no cell larger.
Each cell returns the k best of each of its queries; the k best of those, over all shards, are the result.
Nothing but counts of blocks goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import Scratch

BLOCK = 256
SHARD = 64
CHUNK = 64
SCALE = 256
_LONG = np.iinfo(np.int64)
_PACKED = "ids binary, size int, terms int, matrix binary"


def _blocks(block: int):
    """Rows (vec_id, vector of doubles) -> packed blocks of at most ``block`` rows of one partition."""
    def pack(ids: list, vectors: list) -> pa.RecordBatch:
        terms = max(map(len, vectors))
        matrix = np.zeros((len(ids), terms))
        for i, v in enumerate(vectors):
            matrix[i, :len(v)] = v
        return pa.RecordBatch.from_pydict({
            "ids": [np.array(ids, dtype=np.int64).tobytes()], "size": pa.array([len(ids)], pa.int32()),
            "terms": pa.array([terms], pa.int32()), "matrix": [matrix.tobytes()]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            column = batch.column(1)
            flat, ends = np.asarray(column.flatten()), np.cumsum(np.r_[0, np.asarray(column.value_lengths())])
            for i, v in enumerate(np.asarray(batch.column(0)).tolist()):
                ids.append(v)
                vectors.append(flat[ends[i]:ends[i + 1]])
                if len(ids) == block:
                    yield pack(ids, vectors)
                    ids, vectors = [], []
        if ids:
            yield pack(ids, vectors)
    return run


def _numbered(blocks: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The written blocks with their number ``block`` from 0, and how many there are."""
    placed = scratch.table(blocks.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}  # a row a partition
    total, starts = 0, []
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts or [0]]), (part + 1).cast("int"))
    return placed.withColumn("block", first + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at"), total


def unpacked(r) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.matrix).reshape(r.size, r.terms)


def _widened(matrices: list[np.ndarray], terms: int) -> list[np.ndarray]:
    return [m if m.shape[1] == terms else np.pad(m, ((0, 0), (0, terms - m.shape[1]))) for m in matrices]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole rows: by doubles where every partial sum fits them, else by Python numbers, held to the range of a long."""
    most = lambda m: float(np.abs(m).max(initial=0.0))
    if most(a) * most(b) * max(1, a.shape[1]) < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], dtype=object).reshape(m.shape)
    out = whole(a) @ whole(b).T if a.shape[1] else np.zeros((len(a), len(b)), dtype=object)
    return np.array([[min(max(x, _LONG.min), _LONG.max) for x in row] for row in out.tolist()], dtype=np.int64).reshape(len(a), len(b))


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Summed term maxima: for each query and block, no score in the block is larger (a little added for rounding)."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        sums = up @ high.T + down @ low.T
        room = (up - down) @ np.maximum(np.abs(high), np.abs(low)).T
        return np.nan_to_num(sums + room * 1e-12, nan=np.inf, posinf=np.inf, neginf=-np.inf)


class Best:
    """The k best (score, smallest vec_id) of each query."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), _LONG.min, dtype=np.int64)
        self.id = np.full((queries, k), _LONG.max, dtype=np.int64)
        self.full = np.zeros((queries, k), dtype=bool)

    def open(self, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Whether a block with this bound can still change the result of each query."""
        return ~self.full[q, -1] | (bound >= self.score[q, -1])

    def add(self, q: np.ndarray, ids: np.ndarray, got: np.ndarray, may: np.ndarray) -> None:
        k = self.score.shape[1]
        # most blocks hold no better row for most queries
        better = (may & (~self.full[q, -1:] | (got >= self.score[q, -1:]))).any(axis=1)
        q, got, may = q[better], got[better], may[better]
        score = np.concatenate([self.score[q], got], axis=1)
        own = np.concatenate([self.id[q], np.broadcast_to(ids, got.shape)], axis=1)
        full = np.concatenate([self.full[q], may], axis=1)
        order = _order(score, own, full)[:, :k]
        self.score[q] = np.take_along_axis(score, order, 1)
        self.id[q] = np.take_along_axis(own, order, 1)
        self.full[q] = np.take_along_axis(full, order, 1)


def _order(score: np.ndarray, ids: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Column order of each row: entries that count first, higher scores first, smaller ids first."""
    return np.lexsort((ids, ~score, ~full), axis=1)


def _search(k: int):
    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Packed blocks of one shard, packed blocks of queries -> the k best of each query in the shard."""
        empty = pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        if not len(left) or not len(right):
            return empty
        blocks = [unpacked(r) for r in left.itertuples()]
        asked = [unpacked(r) for r in right.itertuples()]
        terms = max(m.shape[1] for _, m in [*blocks, *asked])
        index = _widened([m for _, m in blocks], terms)
        query = np.concatenate(_widened([m for _, m in asked], terms))
        query_id = np.concatenate([i for i, _ in asked])
        name = np.concatenate([b * BLOCK + np.arange(n) for b, n in zip(right["block"], right["size"], strict=True)])
        bound = _bounds(query, np.stack([m.max(axis=0) for m in index]), np.stack([m.min(axis=0) for m in index]))
        order = np.argsort(-bound, axis=1, kind="stable")
        best, alive = Best(len(query), k), np.arange(len(query))
        for turn in range(len(index)):
            at = order[alive, turn]
            going = best.open(alive, bound[alive, at])
            alive, at = alive[going], at[going]
            if not len(alive):
                break
            for b in np.unique(at):
                q = alive[at == b]
                ids = blocks[b][0]
                best.add(q, ids, scores(query[q], index[b]), query_id[q][:, None] != ids[None, :])
        q, r = np.nonzero(best.full)
        return pd.DataFrame({"query": name[q], "query_id": query_id[q], "vec_id": best.id[q, r], "score": best.score[q, r]})
    return cell


def top_k(spark: SparkSession, vectors: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """vectors (vec_id, embedding, ..) -> query_id, rank, vec_id, score: the k best rows for each row where ``queries`` holds.

    Components become floor(256 * x); a score is the inner product of two rows.  Ties go to the smaller vec_id.  A query's own vec_id is
    no candidate; a repeated row is a candidate, and a query, as often as it stands in the table.  Rows whose
    vec_id or vector is null, or whose vector holds a null or non-finite component, take no part.  Shorter vectors
    count as filled up with zeros, so an empty one scores 0.  Scores beyond a long are held to its range.  An empty table,
    or one without queries, gives no rows.  Other columns are ignored.
    """
    scratch = Scratch(spark, "blocksearch")
    x = lambda c: F.floor(c.cast("double") * SCALE)
    whole = F.transform("embedding", lambda c: F.when(F.abs(c) < 2.0 ** 52, x(c).cast("double")).otherwise(c.cast("double") * SCALE))
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & \
        F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE != float("inf")))
    rows = vectors.withColumn("asked", F.coalesce(queries, F.lit(False))).where(F.coalesce(sound, F.lit(False))) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"), "asked")
    blocks, n_blocks = _numbered(rows.select("vec_id", "vector").mapInArrow(_blocks(BLOCK), _PACKED), scratch)
    asked, n_asked = _numbered(rows.where("asked").select("vec_id", "vector").mapInArrow(_blocks(BLOCK), _PACKED), scratch)
    shards, chunks = max(1, -(-n_blocks // SHARD)), max(1, -(-n_asked // CHUNK))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = blocks.withColumn("shard", F.floor(F.col("block") / SHARD).cast("long")).withColumn("chunk", every(chunks))
    right = asked.withColumn("chunk", F.floor(F.col("block") / CHUNK).cast("long")).withColumn("shard", every(shards))
    found = left.groupBy("shard", "chunk").cogroup(right.groupBy("shard", "chunk")) \
        .applyInPandas(_search(k), "query long, query_id long, vec_id long, score long")
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

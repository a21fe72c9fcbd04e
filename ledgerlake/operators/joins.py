"""Join operators of the star/snowflake layer.

* :func:`star_join` -- fact joined to a list of (possibly enriched) dimensions,
  each inner (drop orphans) or left (keep orphans).  Dimensions arrive with
  prefixed, pruned columns, so no name is ambiguous and only needed columns
  travel.  Outriggers (geography, employee, subcategory, category) are joined
  onto their parent dimension *before* the fact join: (F JOIN S) LEFT JOIN G
  equals F JOIN (S LEFT JOIN G) for an equality on S's columns, and this way
  the snowflake work is proportional to the dimension, not to the fact.
  A dimension that is joined by shuffle keeps small outriggers for later: the
  fact then carries their 8-byte keys through the shuffles that follow, and
  meets their texts in broadcast joins at the end.  Two dimensions of known size
  that both need a shuffle are met in one: see :func:`_grid_join`.
* :func:`orphan_count` -- unmatched keys counted; the fact is pre-aggregated to
  one row per key value first (partial aggregation collapses hot keys such as
  -1 or NULL before any shuffle).
* :func:`not_in_true` -- the SQL ``x NOT IN (SELECT k FROM dim)`` truth value
  as a boolean column over a left join to the distinct keys, guarded by the
  two dimension scalars (empty set, set containing NULL).  Replaces the
  nested-loop plan the planner would pick for ``NOT IN ... OR NOT IN ...``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Turns of the dimensions: those that add nothing but their key (and drop orphans) without a shuffle, then those that
#: may shuffle the fact, while it is narrow, then those that add columns without a shuffle.
NARROW, SHUFFLED, WIDE = 0, 1, 2
# A cell of a grid join hashes at most this many rows of each dimension, each row is sent to at most so many cells.
GRID_MAX_ROWS, GRID_MAX_COPIES = 500_000, 16


@dataclass(frozen=True)
class DimJoin:
    dim: DataFrame
    fact_key: str
    dim_key: str
    how: str = "inner"          # "inner" drops orphans, "left" keeps them
    turn: int = 0               # among joins of one kind: see ``NARROW``
    #: (outrigger, key of ``dim``, key of the outrigger), left-joined after all dimensions
    late: list[tuple[DataFrame, str, str]] = field(default_factory=list)
    rows: int | None = None     # at most, if a copy of it to several tasks costs less than the fact's shuffle


def prefixed(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    """Project ``cols`` of ``df`` renamed ``prefix + col`` (prune before join)."""
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def _grid(first: int, second: int, cells: int) -> tuple[int, int] | None:
    """Into how many parts each of two dimensions is dealt, so that a part is small and there are about ``cells`` pairs of
    parts; None where a row would be copied too often."""
    parts = [max(1, math.ceil(rows / GRID_MAX_ROWS)) for rows in (first, second)]
    if max(parts) > GRID_MAX_COPIES:
        return None
    more = max(1.0, math.sqrt(cells / (parts[0] * parts[1])))
    a, b = (min(GRID_MAX_COPIES, math.ceil(p * more)) for p in parts)
    return a, b


def _grid_join(fact: DataFrame, first: DimJoin, second: DimJoin, a: int, b: int) -> DataFrame:
    """The fact joined to two large dimensions by one shuffle of it.

    One is dealt into ``a`` parts by its key, the other into ``b``.  A fact row goes to the cell of its two keys, a row of
    a dimension to every cell of its part, so each fact row meets each of its partners in exactly one task; the first
    dimension's texts never travel with the fact."""
    part = lambda key, n: F.pmod(F.hash(F.col(key)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # an expression, not a column that would travel too
    cell = part(first.fact_key, a) * b + part(second.fact_key, b)
    out = fact.repartitionById(a * b, cell)
    sides = [(first, first.dim.withColumn("_copy", every(b)), part(first.dim_key, a) * b + F.col("_copy")),
             (second, second.dim.withColumn("_copy", every(a)), F.col("_copy") * b + part(second.dim_key, b))]
    for j, copies, own in sides:
        dim = copies.withColumn("_cell", own).drop("_copy").repartitionById(a * b, F.col("_cell")).hint("shuffle_hash")
        out = out.join(dim, (F.col(j.fact_key) == F.col(j.dim_key)) & (cell == F.col("_cell")), j.how).drop("_cell")
    return out


def _one_shuffle(fact: DataFrame, joins: list[DimJoin]) -> tuple[int, int] | None:
    """The grid by which the next two dimensions are met, if they may be: equal keys must hash alike."""
    if len(joins) < 2 or None in (joins[0].rows, joins[1].rows) or joins[0].how != joins[1].how:
        return None
    if any(fact.schema[j.fact_key].dataType != j.dim.schema[j.dim_key].dataType for j in joins[:2]):
        return None
    spark = fact.sparkSession
    cells = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    return _grid(joins[0].rows, joins[1].rows, cells)


def star_join(fact: DataFrame, joins: list[DimJoin], texts: bool = True) -> DataFrame:
    """Fact joined to each dimension.  Inner joins come first so
    orphan rows are dropped before any shuffle a large dimension may need; each kind goes by its turns.
    ``texts``: whether the dimensions' texts are wanted.  If not, all joins without a shuffle come first, for the fact
    then needn't carry their keys."""
    ordered = sorted(joins, key=lambda j: (j.how != "inner", j.turn if texts else j.turn == SHUFFLED))
    out, left = fact, ordered
    while left:
        grid = _one_shuffle(out, left)
        if grid:
            out, left = _grid_join(out, left[0], left[1], *grid), left[2:]
        else:
            out, left = out.join(left[0].dim, F.col(left[0].fact_key) == F.col(left[0].dim_key), left[0].how), left[1:]
    for outrigger, parent_key, key in [o for j in ordered for o in j.late]:
        out = out.join(outrigger, F.col(parent_key) == F.col(key), "left")
    return out


def orphan_count(fact: DataFrame, fact_key: Column, dim: DataFrame, dim_key: Column) -> DataFrame:
    """One row ``Fail_Count``: fact rows whose key has no match in ``dim``.

    Same rows as ``fact LEFT JOIN dim ON fk = dk WHERE dk IS NULL``: a NULL fact
    key never matches, so it counts as an orphan.  The fact is first reduced
    to one row per key value (a hot key becomes one row per task); the join
    is written as left join + IS NULL because the optimizer would push an
    anti join back below that aggregation.
    """
    per_key = fact.groupBy(fact_key.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    keys = dim.select(dim_key.alias("_dk"))
    orphans = per_key.join(keys, F.col("_k") == F.col("_dk"), "left").where(F.col("_dk").isNull())
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("Fail_Count"))


def key_flags(dim: DataFrame, key: str, tag: str) -> tuple[DataFrame, Column, Column]:
    """Distinct non-NULL keys of ``dim`` tagged ``{tag}_present``, plus the two
    ``NOT IN`` guards as scalar subqueries (computed once, no join): the key
    set is empty / the key column holds a NULL."""
    keys = (dim.select(F.col(key).alias(f"{tag}_key")).where(F.col(f"{tag}_key").isNotNull())
            .distinct().withColumn(f"{tag}_present", F.lit(True)))
    stats = dim.agg(F.struct((F.count(F.lit(1)) == 0).alias("empty"),
                             (F.count(F.lit(1)) > F.count(F.col(key))).alias("has_null"))
                    .alias("s")).scalar()
    return keys, stats.getField("empty"), stats.getField("has_null")


def not_in_true(x: Column, present: Column, empty: Column, has_null: Column) -> Column:
    """TRUE exactly when SQL ``x NOT IN (set)`` is TRUE, given ``present``
    (the matched key flag from a left join to the distinct keys) and the
    guards of :func:`key_flags`: an empty set makes it TRUE for any x; else a
    NULL x or a NULL in the set make it NULL (not TRUE)."""
    return empty | (x.isNotNull() & ~has_null & present.isNull())

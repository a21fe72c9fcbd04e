"""Keep-latest deduplication (``ROW_NUMBER() OVER (PARTITION BY key ORDER BY
DateKey DESC) = 1``).

The reference leaves ties arbitrary; we break them on the remaining columns so
the result is deterministic.  NULL dates rank first in DESC, as in the source
dialect (Spark's default would put them last).  Catalyst plans ``rank = 1`` as
a ``WindowGroupLimit``: a partial top-1 per key runs *before* the shuffle, so
a key repeated a billion times ships one row per map task, not a billion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_window(key: str, order_col: str, tiebreak: list[str], within: tuple[str, ...] = ()) -> Window:
    return Window.partitionBy(*within, key).orderBy(
        F.col(order_col).desc_nulls_first(),
        *[F.col(c).asc_nulls_last() for c in tiebreak])


def keep_latest(df: DataFrame, key: str, order_col: str = "DateKey",
                rank_col: str = "RowRank", within: tuple[str, ...] = ()) -> DataFrame:
    """``SELECT *, ROW_NUMBER() ... AS RowRank ... WHERE RowRank = 1``.

    ``within`` names columns that the key determines: rows already dealt out by
    them are ranked where they are, without another shuffle."""
    tiebreak = [c for c in df.columns if c not in (key, order_col, *within)]
    w = latest_window(key, order_col, tiebreak, within)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1)

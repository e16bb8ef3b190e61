"""W1 latest-per-key and P8 distinct relationships."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# An order item is (column, descending, nulls_first).  ``nulls_first=None`` uses
# the warehouse default: NULLs first when descending, last when ascending.
OrderItem = tuple[str | Column, bool, bool | None]


def sort_column(item: OrderItem) -> Column:
    c, desc, nulls_first = item
    col = F.col(c) if isinstance(c, str) else c
    if nulls_first is None:
        nulls_first = desc
    if desc:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem],
                   rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (ROW_NUMBER() = 1).

    Planned as a window whose rank filter Catalyst turns into a WindowGroupLimit:
    each map task keeps only its top row per key before the shuffle, so a hot
    key sends at most one row per input partition across the network.
    """
    w = Window.partitionBy(*keys).orderBy(*[sort_column(o) for o in order])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) == 1).drop(rank_col)


def newest_rows(df: DataFrame, key: str, at: str) -> DataFrame:
    """All rows of each key with its newest ``at`` (NULL counts as newest), without sorting the rows.

    The newest values are a hash aggregate with partial results.  Rows without a key (a group too) need no join.
    """
    open_, last = F.max(F.col(at).isNull()).alias("_open"), F.max(at).alias("_last")
    cond = F.when(F.col("_open"), F.col(at).isNull()).otherwise(F.col(at) == F.col("_last"))
    tops = df.where(F.col(key).isNotNull()).groupBy(key).agg(open_, last)
    named = df.where(F.col(key).isNotNull()).join(tops, key).where(cond)
    loose = df.where(F.col(key).isNull())
    loose = loose.crossJoin(F.broadcast(loose.agg(open_, last))).where(cond)  # one row
    return named.select(*df.columns).unionByName(loose.select(*df.columns))


def distinct_pairs(df: DataFrame, cols: Sequence[str], not_null: bool = True) -> DataFrame:
    """SELECT DISTINCT of ``cols`` (optionally dropping rows with a NULL part).

    A hash aggregate with map-side combine: duplicates collapse before the shuffle.
    """
    out = df.select(*cols)
    if not_null:
        cond = None
        for c in cols:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        out = out.filter(cond)
    return out.distinct()

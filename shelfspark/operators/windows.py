"""Window operators: previous-row values (W2/W4) and a distributed global NTILE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators.dedup import OrderItem, sort_column

#: Ranges of a global order.
NTILE_RANGES = 64


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem],
                  columns: Mapping[str, str]) -> DataFrame:
    """LAG of several columns over one window spec: ``{source: new_name}``.

    All lags share one partitioning + sort, so Catalyst plans a single
    exchange and a single Window node for them.
    """
    w = Window.partitionBy(*keys).orderBy(*[sort_column(o) for o in order])
    return df.withColumns({new: F.lag(src).over(w) for src, new in columns.items()})


def with_previous_segmented(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem], columns: Mapping[str, str],
                            segment: Column) -> DataFrame:
    """``with_previous`` for keys with more rows than one task should sort.

    ``segment`` cuts a key's rows into runs and must not fall along ``order`` (the month of the order's date, say; the
    order's own direction and place of NULLs count).  LAG looks back inside a segment; a segment's first row takes the
    last row of the key's segment before it, from a table with one row per key and segment.  So a task holds one segment
    of a key, and what is sorted per key is its segments.  Rows that tie in ``order`` are ordered as in ``with_previous``:
    not at all; append a unique key.
    """
    at = [f"_o{i}" for i in range(len(order))]
    rows = df.withColumns({o: F.col(c) if isinstance(c, str) else c for o, (c, _, _) in zip(at, order, strict=True)})
    rows = rows.withColumn("_segment", segment)
    sorts = [sort_column((o, falling, nulls_first)) for o, (_, falling, nulls_first) in zip(at, order, strict=True)]
    inside = Window.partitionBy(*keys, "_segment").orderBy(*sorts)
    held = F.struct(*[F.col(c) for c in columns])
    rows = rows.withColumns({"_first": F.row_number().over(inside) == 1, "_last": F.lead(F.lit(False), 1, True).over(inside)})
    rows = rows.withColumns({new: F.lag(src).over(inside) for src, new in columns.items()})
    # one row per key and segment
    ends = rows.where("_last").select(*keys, "_segment", *at, held.alias("_held"))
    along = Window.partitionBy(*keys).orderBy(*sorts)
    carried = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_segment").alias("_s"), F.lag("_held").over(along).alias("_carried"))
    same = F.col("_segment").eqNullSafe(F.col("_s")) & F.col("_first")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(carried, same, "left")
    return joined.select(
        *df.columns, *[F.when(F.col("_first"), F.col(f"_carried.{src}")).otherwise(F.col(new)).alias(new) for src, new in columns.items()]
    )


def _code(df: DataFrame, name: str) -> Column:
    """A number that never falls where the column rises: values may share one, which only makes ranges less even."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):  # the first six bytes
        head = F.rpad(F.hex(F.substring(F.col(name).cast("binary"), 1, 6)), 12, "0")
        return F.when(F.col(name).isNotNull(), F.conv(head, 16, 10).cast("double"))
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("double")
    return F.col(name).cast("double")


def _range(code: str, cuts: str, order: OrderItem, ranges: int) -> Column:
    """The range of a code: between two cuts, or equal to one, so that a value with many rows has a range of its own.
    Counted down for a falling order; NULL before or after all others."""
    _, falling, nulls_first = order
    below = F.size(F.filter(cuts, lambda x: x < F.col(code))) + F.size(F.filter(cuts, lambda x: x <= F.col(code)))
    at = F.when(F.isnull(cuts), F.lit(0)).otherwise(-below if falling else below)
    return F.when(F.isnull(code), F.lit(-2 * ranges if nulls_first else 2 * ranges)).otherwise(at)


def global_ntile(df: DataFrame, n: int, order: Sequence[OrderItem], out: str,
                 num_partitions: int = NTILE_RANGES) -> DataFrame:
    """NTILE(n) over a global order without pulling all rows into one task, as one lazy plan.

    1. a quantile sketch of the first order column gives the cuts of ``num_partitions`` ranges, as a scalar subquery;
    2. a range of a single value (or NULL) with more than twice its share is cut again by a sketch of the second column;
    3. exact counts of the ranges (a small table) give each its offset;
    4. the rank of a row is its position inside its range, one task each, plus the offset, and gives the bucket: the
       first ``N mod n`` buckets hold one row more.

    The cuts only say how even the ranges are; ranks are exact.  No job runs before the result is asked for, and
    nothing is sampled or checkpointed.  The input is read four times, three of them in its order columns alone: give a
    written table rather than a long plan.  Rows that tie in the first two columns are sorted in one task.  ``order`` must be a total order
    (append a unique key) for a deterministic result; an empty input gives no rows.
    """
    ranges, columns = max(1, num_partitions), df.columns
    names = [f"_o{i}" for i in range(len(order))]
    df = df.withColumns({o: F.col(c) if isinstance(c, str) else c for o, (c, _, _) in zip(names, order, strict=True)})
    order = [(o, falling, falling if nulls_first is None else nulls_first) for o, (_, falling, nulls_first) in zip(names, order, strict=True)]
    fractions = F.array(*[F.lit(k / ranges) for k in range(1, ranges)]) if ranges > 1 else F.array(F.lit(0.5))
    second = order[1] if len(order) > 1 else order[0]
    base = df.withColumns({"_c1": _code(df, order[0][0]), "_c2": _code(df, second[0])})
    cuts = base.agg(F.percentile_approx("_c1", fractions, 10_000)).scalar()
    ranged = base.withColumn("_first_cuts", cuts).withColumn("_r1", _range("_c1", "_first_cuts", order[0], ranges)).drop("_first_cuts")
    # one row per range
    single = F.min("_o0").eqNullSafe(F.max("_o0")) & ((F.count("_o0") == 0) | (F.count("_o0") == F.count(F.lit(1))))
    sizes = ranged.groupBy("_r1").agg(
        F.count(F.lit(1)).alias("_m"), F.percentile_approx("_c2", fractions, 10_000).alias("_cuts"), single.alias("_single")
    )
    total = F.sum("_m").over(Window.partitionBy())
    again = F.when((F.col("_m") * ranges > 2 * total) & F.col("_single"), F.col("_cuts"))
    cut2 = sizes.select(F.col("_r1").alias("_r"), again.alias("_cuts"))
    placed = ranged.join(F.broadcast(cut2), F.col("_r1") == F.col("_r")).drop("_r")
    placed = placed.withColumn("_r2", F.when(F.isnull("_cuts"), F.lit(0)).otherwise(_range("_c2", "_cuts", second, ranges)))
    # some ranges times ranges at worst: a window over them in one task is fine
    counts = placed.groupBy("_r1", "_r2").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.orderBy("_r1", "_r2").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_r1").alias("_a"), F.col("_r2").alias("_b"), F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_offset"),
        F.sum("_m").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_r1", "_r2").orderBy(*[sort_column(o) for o in order])
    ranked = placed.withColumn("_at", F.row_number().over(inside)).join(
        F.broadcast(offsets), (F.col("_r1") == F.col("_a")) & (F.col("_r2") == F.col("_b"))
    )
    r = F.col("_offset") + F.col("_at")
    q, rest = F.floor(F.col("_total") / n), F.col("_total") % n
    big = rest * (q + 1)
    bucket = F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1).otherwise(rest + F.floor((r - 1 - big) / q) + 1)
    return ranked.select(*columns, bucket.cast("int").alias(out))

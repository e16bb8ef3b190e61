"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows get dense global numbers 0..n-1; a keyed permutation p of 0..n-1 shuffles them; row number i goes to shard
p(i) mod S, slot p(i) div S.  Shard sizes differ by one at most, slots are gapless, and place and row number follow
from each other (``permute`` / ``inverse``) without any lookup.

The network works on (l, r) in Z_a x Z_b with a*b >= n as tight as possible (a = ceil(sqrt(n)), b = ceil(n/a)), so
fewer than a values lie outside 0..n-1; values outside walk on along their cycle until they fall inside.

Numbers: rows are counted per identity (key, size, crc32) first, so a key that holds a third of all rows is one counted
row, not a hot partition.  Identities are spread over a fixed number of buckets by hash and ordered inside a bucket; a
table of at most BUCKETS running totals gives each bucket its first number.

Edge cases: null keys and null texts are ordinary values (size 1, crc32 0); rows that agree in key, size and crc32 are
interchangeable and get consecutive numbers; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only

BUCKETS = 4096
ROUNDS = 6
#: A walk has fewer than ceil(sqrt(n)) steps; 64 suffice for every n up to 4,096, and beyond that each further step
#: has a chance under 1/64.  A walk that is not over by then raises an error instead of giving a wrong place.
STEPS = 64


def _round(seed: int, k: Column, half: Column) -> Column:
    """60 bits of md5 over seed, round and half: the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), k.cast("string"), half.cast("string"))), 1, 15), 16, 10).cast("long")


def _once(x: Column, a: Column, b: Column, seed: int, back: bool) -> Column:
    """The network on x = l * b + r: even rounds add a hash of r to l, odd rounds one of l to r; ``back`` undoes them."""
    rounds = F.array(*[F.lit(k) for k in (reversed(range(ROUNDS)) if back else range(ROUNDS))])
    sign = -1 if back else 1

    def step(v: Column, k: Column) -> Column:
        left, right = F.call_function("div", v, b), v % b
        moved_l = F.pmod(left + sign * (_round(seed, k, right) % a), a) * b + right
        moved_r = left * b + F.pmod(right + sign * (_round(seed, k, left) % b), b)
        return F.when(k % 2 == 0, moved_l).otherwise(moved_r)

    return F.aggregate(rounds, x, step)


def _walk(x: Column, n: Column, seed: int, back: bool) -> Column:
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.call_function("div", n + a - 1, a)
    out = F.aggregate(
        F.array_repeat(F.lit(0), STEPS),
        _once(x, a, b, seed, back),
        lambda v, _: F.when(v < n, v).otherwise(_once(v, a, b, seed, back)),
    )
    return F.when(out < n, out).otherwise(F.raise_error(F.lit("cycle walk not over")).cast("long"))


def permute(x: Column, n: Column, seed: int) -> Column:
    """The place of row number ``x`` among 0..n-1."""
    return _walk(x, n, seed, back=False)


def inverse(y: Column, n: Column, seed: int) -> Column:
    """The row number at place ``y``: ``inverse(permute(x)) = x``."""
    return _walk(y, n, seed, back=True)


def row_numbers(df: DataFrame, by: list[str]) -> DataFrame:
    """One row per input row: ``by`` columns, ``row_number`` (dense from 0) and ``n_rows``.

    Reproducible: it depends on the values only, not on files, partitions or the cluster.
    """
    names = [f"k{i}" for i in range(len(by))]
    ids = only(df, *by).toDF(*names).groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    # md5 spreads identities; null and empty differ
    spread = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in names]))
    ids = ids.withColumn("bucket", F.pmod(F.conv(F.substring(spread, 1, 8), 16, 10).cast("long"), F.lit(BUCKETS)).cast("int"))
    inside = Window.partitionBy("bucket").orderBy(*[F.col(c).asc_nulls_first() for c in names])
    ids = ids.withColumn("upto", F.sum("copies").over(inside))
    totals = ids.groupBy("bucket").agg(F.sum("copies").alias("rows"))  # at most BUCKETS rows
    starts = totals.select(
        F.col("bucket").alias("b"),
        (F.sum("rows").over(Window.orderBy("bucket")) - F.col("rows")).alias("first"),
        F.sum("rows").over(Window.partitionBy(F.lit(0))).alias("n_rows"),
    )
    numbered = ids.join(F.broadcast(starts), ids["bucket"] == starts["b"])
    first = F.col("first") + F.col("upto") - F.col("copies")
    out = numbered.select(*names, "n_rows", F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("row_number"))
    return out.toDF(*by, "n_rows", "row_number")


def shard(df: DataFrame, by: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``by`` columns plus ``row_number``, ``n_rows``, ``shard`` and ``slot`` for every input row."""
    place = permute(F.col("row_number"), F.col("n_rows"), seed)
    return (
        row_numbers(df, by)
        .withColumn("place", place)
        .withColumn("shard", (F.col("place") % shards).cast("int"))
        .withColumn("slot", F.call_function("div", F.col("place"), F.lit(shards)).cast("long"))
    )

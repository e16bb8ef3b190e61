"""I4 against a growing target: a log of loaded files with a Bloom filter each.

The anti join of an incremental load asks which delivered rows are in the target already.  A row's key includes the
file it came from, so the log answers most of it without reading the target:

* a file that the log doesn't have: all its rows are new;
* a file that it has: the file's Bloom filter says for each key "not there" (exact) or "perhaps";
* only for "perhaps" rows the target is read, and only the loads that hold their files, for the exact anti join.

A filter is a row of blocks of 32,768 bits, as many as the file's keys need at ``KEYS_PER_BLOCK`` keys each; a key has
one block and ``PROBES`` bits in it.  So about one key in a million that isn't there is "perhaps", whatever the file's
size, and a file of a third of all rows is many rows of the log.  All built from the bitmap functions of Spark SQL.

As in the plain anti join, a key with a NULL matches nothing: such rows are always new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.incremental import new_rows

BLOCK_BITS = 32_768
KEYS_PER_BLOCK = 1_000
PROBES = 6
LOG_SCHEMA = "file string, load string, blocks long, block long, bits binary"


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k).cast("string") for k in keys])


def _bits(keys: Sequence[str]) -> list[Column]:
    """The key's positions in its block."""
    return [F.pmod(_hash(keys, 1 + i), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def _block(keys: Sequence[str], blocks: Column) -> Column:
    return F.pmod(_hash(keys, 0), blocks)


def log_entries(rows: DataFrame, keys: Sequence[str], file_col: str, load: str) -> DataFrame:
    """(file, load, blocks, block, bits) of the rows of one load; files whose keys are all NULL get an entry too."""
    others = [k for k in keys if k != file_col]
    known = F.lit(True)
    for k in others:
        known = known & F.col(k).isNotNull()
    src = rows.where(F.col(file_col).isNotNull()).select(F.col(file_col).alias("file"), known.alias("known"), *others)
    sizes = src.groupBy("file").agg(F.greatest(F.lit(1), F.ceil(F.count_if("known") / KEYS_PER_BLOCK)).cast("long").alias("blocks"))
    keyed = src.where("known").join(sizes, "file")
    probes = keyed.select("file", "blocks", _block(others, F.col("blocks")).alias("block"), F.explode(F.array(*_bits(others))).alias("at"))
    filters = probes.groupBy("file", "blocks", "block").agg(F.bitmap_construct_agg("at").alias("bits"))
    empty = sizes.join(src.where("known").select("file").distinct(), "file", "left_anti")
    blank = empty.select("file", "blocks", F.lit(0).cast("long").alias("block"), F.lit(None).cast("binary").alias("bits"))
    both = filters.unionByName(blank)
    return both.select("file", F.lit(load).alias("load"), "blocks", "block", "bits")


def _has(bits: Column, at: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    octet = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", octet, (at % 8).cast("int")) == 1


def probed(incoming: DataFrame, log: DataFrame, keys: Sequence[str], file_col: str) -> DataFrame:
    """The incoming rows with ``_loads``: the loads that perhaps hold their key, empty for rows that are surely new.

    One join by file (sizes), one by file and block: no target row is read, and both sides are as large as the delivery
    and the log of its files.
    """
    others = [k for k in keys if k != file_col]
    rows = incoming.withColumn("_row", F.monotonically_increasing_id())
    asked = rows.select("_row", F.col(file_col).alias("file"), *others).dropna()
    sizes = log.select("file", "load", "blocks").distinct()
    placed = asked.join(sizes, "file").withColumn("block", _block(others, F.col("blocks")))
    met = placed.join(log.where("bits IS NOT NULL").select("file", "load", "block", "bits"), ["file", "load", "block"])
    all_set = F.lit(True)
    for at in _bits(others):
        all_set = all_set & _has(F.col("bits"), at)
    perhaps = met.where(all_set).groupBy("_row").agg(F.collect_set("load").alias("_loads"))
    return rows.join(perhaps, "_row", "left").withColumn("_loads", F.coalesce("_loads", F.array().cast("array<string>"))).drop("_row")


def new_rows_logged(incoming: DataFrame, log: DataFrame | None, read_loads, keys: Sequence[str], file_col: str) -> DataFrame:
    """The incoming rows whose key the target lacks.  ``read_loads(names)`` gives the target's rows of some loads; it
    is not called where the log rules all rows out.  ``incoming`` must be stable (checkpointed), as it is read twice."""
    if log is None:
        return incoming
    asked = probed(incoming, log, keys, file_col)
    # the loads that hold a file of the delivery: no more than the table has loads
    loads = sorted(r["load"] for r in asked.select(F.explode("_loads").alias("load")).distinct().collect())
    sure = asked.where(F.size("_loads") == 0).drop("_loads")
    if not loads:
        return sure
    return sure.unionByName(new_rows(asked.where(F.size("_loads") > 0).drop("_loads"), read_loads(loads), keys))

"""Type-2 slowly changing history (I7, I8) on immutable files (no MERGE)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.keys import surrogate_key
from shelfspark.operators.dedup import OrderItem, latest_per_key

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to", "is_current")


def _key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def scd2_build(history: DataFrame, key: str | Sequence[str], updated_at: str,
               tie_break: Sequence[OrderItem] = ()) -> DataFrame:
    """Replay every delivery at once: one version per (key, distinct ``updated_at``).

    Within a (key, updated_at) the newest row under ``tie_break`` wins (the
    snapshot's own dedup).  ``valid_to`` is the next version's ``valid_from``
    (LEAD over the key), NULL for the open version.
    """
    keys = _key_list(key)
    versions = latest_per_key(history, keys + [updated_at], list(tie_break)) if tie_break else \
        history.dropDuplicates(keys + [updated_at])
    w = Window.partitionBy(*keys).orderBy(F.col(updated_at).asc())
    return (versions
            .withColumn("scd_id", surrogate_key(*keys, updated_at))
            .withColumn("valid_from", F.col(updated_at))
            .withColumn("valid_to", F.lead(updated_at).over(w))
            .withColumn("is_current", F.col("valid_to").isNull()))


def scd2_apply(current: DataFrame | None, incoming: DataFrame, key: str | Sequence[str], updated_at: str,
               order: Sequence[OrderItem] | None = None) -> DataFrame:
    """One snapshot run: close changed open versions, open new ones, keep the rest.

    ``incoming`` is reduced to its newest row per key first (``order``, default
    ``updated_at`` descending, undated rows first as in the dialect).  An undated
    row opens a version of a new key and never replaces one.  A key whose newest ``updated_at`` is not later
    than its open version is left unchanged, so re-running adds nothing.
    Returns the complete new history, to be written to a new location.
    """
    keys = _key_list(key)
    order = list(order) if order else [(updated_at, True, True)]
    latest = latest_per_key(incoming, keys, order)
    fresh = (latest.withColumn("scd_id", surrogate_key(*keys, updated_at))
                   .withColumn("valid_from", F.col(updated_at))
                   .withColumn("valid_to", F.lit(None).cast(latest.schema[updated_at].dataType))
                   .withColumn("is_current", F.lit(True)))
    if current is None:
        return fresh
    closed = current.filter(F.col("valid_to").isNotNull())
    open_ = current.filter(F.col("valid_to").isNull())
    newest = latest.select(*keys, F.col(updated_at).alias("_new_ts"))
    open_out = (open_.join(newest, keys, "left")
                .withColumn("_chg", F.coalesce(F.col("_new_ts") > F.col(updated_at), F.lit(False)))
                .withColumn("valid_to", F.when(F.col("_chg"), F.col("_new_ts")).otherwise(F.col("valid_to")))
                .withColumn("is_current", ~F.col("_chg"))
                .drop("_new_ts", "_chg"))
    prev = open_.select(*keys, F.col(updated_at).alias("_old_ts"), F.lit(True).alias("_known"))
    opened = (fresh.join(prev, keys, "left")
                   .filter(F.col("_known").isNull() | (F.col(updated_at) > F.col("_old_ts")))
                   .drop("_old_ts", "_known"))
    return closed.unionByName(open_out).unionByName(opened, allowMissingColumns=True)

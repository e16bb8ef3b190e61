"""Daily inventory by product x store (silver inventory: P8 J1 W2 A2 J3 M16-M21 W3 W4 K1).

Plan notes (what differs from a literal translation, with identical results):

* The stock history is per product; every store that sold the product gets
  the product's snapshots (J1).  LAG over (product, store) by date therefore
  equals LAG over product by date, so both lags (W2 beginning stock, W4
  previous date) are computed once on the product history *before* the
  fan-out: one window over N rows instead of N x stores.
* That day's sales (J3) are joined on (product, date) *before* the fan-out:
  completed sales are first summed to (product, store, day), so one
  (product, day) carries at most one entry per store -- a map bounded by the
  store dimension, not by row counts -- and each fanned-out row looks its
  store up.  Every join in the chain is then keyed on the product alone and
  the fanned-out rows (the largest intermediate) are never shuffled.
* Attributes of the product (``attributes``) are looked up after the day's
  sales, where the snapshots are dealt by product for the lag window: looked
  up before, they would be dealt by product, by product and date and by
  product again.
* Dimension columns (keys, names) are looked up on the snapshots and on the
  product x store pairs, before they fan out (``snapshot_lookups``,
  ``store_lookups``).
* The per-date purchase total (W3) is an aggregate + broadcast join instead
  of ``SUM() OVER (PARTITION BY date)``, so no task ever holds a whole day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import config
from shelfspark.functions import metrics as M
from shelfspark.functions.keys import surrogate_key
from shelfspark.operators.dedup import distinct_pairs
from shelfspark.operators.joins import share_of_group, star_lookup
from shelfspark.operators.windows import with_previous

INVENTORY_COLUMNS = [
    "inventory_key", "product_id", "store_id", "inventory_date", "beginning_stock", "purchased_quantity",
    "sold_quantity", "ending_stock", "inventory_value", "stock_turnover_ratio",
    "supplier_contribution_percentage", "reorder_level", "supplier_id", "snapshot_gap_flag",
    "snapshot_gap_days", "low_stock_flag", "negative_inferred_purchase_flag",
]


#: A star lookup: dimension, key or keys, columns.
Lookup = tuple[DataFrame, str | Sequence[str], Sequence[str]]

#: Partitions of fanned-out rows dealt anew, in shuffle partitions.
CLUSTERED_PARTITIONS = 8


def _listed(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def product_store(items: DataFrame) -> DataFrame:
    """Distinct (product, store) pairs that ever appeared on an order."""
    return distinct_pairs(items, ["product_id", "store_id"])


def typed_snapshots(history: DataFrame) -> DataFrame:
    return history.select(
        "product_id",
        F.col("source_snapshot_date").alias("inventory_date"),
        F.col("stock_quantity").alias("ending_stock"),
        *[c for c in ("reorder_level", "supplier_id", "cost_price") if c in history.columns])


def previous_snapshot(snaps: DataFrame) -> DataFrame:
    """W2 + W4: previous stock and previous date per product (one window spec)."""
    return with_previous(snaps, ["product_id"], [("inventory_date", False, False)],
                         {"ending_stock": "beginning_stock", "inventory_date": "previous_inventory_date"})


def stock_snapshots(history: DataFrame) -> DataFrame:
    """Typed per-product snapshots with previous stock and previous date."""
    return previous_snapshot(typed_snapshots(history))


def fan_out(snapshots: DataFrame, pairs: DataFrame) -> DataFrame:
    """Product snapshots x stores that sold the product (inner)."""
    return snapshots.join(pairs, "product_id", "inner")


def completed_sales(items: DataFrame, statuses: Sequence[str] = config.COMPLETED_STATUSES) -> DataFrame:
    """A2: quantity sold per (product, store, order date) over completed orders."""
    return (items.filter(F.lower("order_status").isin(*statuses)
                         & F.col("product_id").isNotNull() & F.col("store_id").isNotNull()
                         & F.col("order_date").isNotNull())
                 .groupBy("product_id", "store_id", F.col("order_date").alias("inventory_date"))
                 .agg(F.sum("quantity").alias("sold_quantity")))


def with_sales(stock: DataFrame, sales: DataFrame) -> DataFrame:
    """Attach that day's sales (0 when none) with a (product, store, date) join."""
    return (stock.join(sales, ["product_id", "store_id", "inventory_date"], "left")
                 .withColumn("sold_quantity", F.coalesce("sold_quantity", F.lit(0).cast("bigint"))))


def day_sales_by_store(sales: DataFrame) -> DataFrame:
    """(product, date) -> map(store -> sold quantity); at most one entry per store."""
    return sales.groupBy("product_id", "inventory_date").agg(
        F.map_from_entries(F.collect_list(F.struct("store_id", "sold_quantity"))).alias("_store_sales"))


def fan_out_with_sales(history: DataFrame, pairs: DataFrame, sales: DataFrame, snapshot_lookups: Sequence[Lookup] = (),
                       store_lookups: Sequence[Lookup] = (), cluster_by: Mapping[str, Column] | None = None,
                       attributes: Sequence[Lookup] = ()) -> DataFrame:
    """W2/W4 + J1 + J3 without shuffling the fanned-out rows.

    Same rows as ``with_sales(fan_out(stock_snapshots(history), pairs), sales)``.
    The day map joins the history on (product, date) -- both sides are
    aggregates hashed on those keys, so the join needs no exchange -- then
    the lag window and the fan-out are both keyed on the product.  Every
    sale's (product, store) pair is in ``pairs`` (both come from the same
    order items), so a store missing from the day's map sold nothing.

    ``attributes`` are star lookups that belong to the history itself: the lag
    sees a snapshot as often as they repeat it.  Left joins commute, so they
    follow the day map.

    ``snapshot_lookups`` and ``store_lookups`` are star lookups of a snapshot's
    and of a store's columns.  A left join of either side commutes with the
    fan-out, so they are made on the two small sides.  ``cluster_by`` (new
    columns of a snapshot) deals the result by these: the snapshots are shuffled
    with a list of their stores (as bounded as the day map), and fan out afterwards.
    """
    snaps = typed_snapshots(history).join(day_sales_by_store(sales), ["product_id", "inventory_date"], "left")
    snaps = star_lookup(previous_snapshot(star_lookup(snaps, attributes)), snapshot_lookups)
    if cluster_by:
        spark = history.sparkSession
        lists = pairs.groupBy("product_id").agg(F.array_sort(F.collect_list("store_id")).alias("_stores"))
        whole = isinstance(pairs.schema["store_id"].dataType, T.IntegralType)
        if whole:   # as text, a list takes a third of the bytes; other ids may hold the comma
            lists = lists.withColumn("_stores", F.array_join(F.col("_stores").cast("array<string>"), ","))
        nested = fan_out(snaps.withColumns(dict(cluster_by)), lists)
        # a fixed number: partitions joined by their size would hold many times the rows once these fan out
        parts = CLUSTERED_PARTITIONS * int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = nested.repartition(parts, *cluster_by)
        if whole:
            rows = rows.withColumn("_stores", F.split("_stores", ",").cast(T.ArrayType(pairs.schema["store_id"].dataType)))
        rows = rows.select(*[c for c in rows.columns if c != "_stores"], F.explode("_stores").alias("store_id"))
        rows = star_lookup(rows, [(F.broadcast(dim.select(*_listed(keys), *cols)), keys, cols) for dim, keys, cols in store_lookups])
    else:
        if store_lookups:
            pairs = star_lookup(pairs.repartition("product_id"),
                                [(F.broadcast(dim.select(*_listed(keys), *cols)), keys, cols) for dim, keys, cols in store_lookups])
        rows = fan_out(snaps, pairs)
    return (rows.withColumn("sold_quantity",
                            F.coalesce(F.try_element_at("_store_sales", F.col("store_id")), F.lit(0).cast("bigint")))
                .drop("_store_sales"))


def inventory_metrics(df: DataFrame) -> DataFrame:
    """Purchases, value, average stock, turnover."""
    avg_inv = M.average_inventory("beginning_stock", "ending_stock")
    return df.withColumns({
        "purchased_quantity": M.purchased("beginning_stock", "ending_stock", "sold_quantity"),
        "inventory_value": M.inventory_value("ending_stock", "cost_price"),
        "stock_turnover_ratio": M.turnover("sold_quantity", avg_inv),
    })


def silver_inventory(history: DataFrame, items: DataFrame, snapshot_lookups: Sequence[Lookup] = (),
                     store_lookups: Sequence[Lookup] = (), cluster_by: Mapping[str, Column] | None = None,
                     attributes: Sequence[Lookup] = ()) -> DataFrame:
    """The inventory, with the columns of the lookups after its own (see ``fan_out_with_sales``)."""
    pairs, sales = product_store(items), completed_sales(items)
    calc = inventory_metrics(fan_out_with_sales(history, pairs, sales, snapshot_lookups, store_lookups, cluster_by, attributes))
    # the totals are those of the inventory itself: a lookup may repeat rows
    plain = inventory_metrics(fan_out_with_sales(history, pairs, sales, attributes=attributes)) if snapshot_lookups or store_lookups else None
    shared = share_of_group(calc, "inventory_date", "purchased_quantity", "supplier_contribution_percentage",
                            zero_value=0.0, totals_of=plain)
    more = dict.fromkeys([c for _, _, cols in (*snapshot_lookups, *store_lookups) for c in cols] + list(cluster_by or ()))
    return shared.withColumns({
        "inventory_key": surrogate_key("product_id", "store_id", "inventory_date"),
        "snapshot_gap_flag": M.gap_flag("previous_inventory_date", "inventory_date"),
        "snapshot_gap_days": M.gap_days("previous_inventory_date", "inventory_date"),
        "low_stock_flag": M.low_stock("ending_stock", "reorder_level"),
        "negative_inferred_purchase_flag": M.negative_purchase("purchased_quantity"),
    }).select(*INVENTORY_COLUMNS, *more)

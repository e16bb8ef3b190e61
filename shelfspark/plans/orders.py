"""Order roll-up (A1) and the silver order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import metrics as M


def order_rollup(items: DataFrame) -> DataFrame:
    """A1: per-order item totals.

    ``total_discount`` sums the item discount *rates* (as the reference does);
    ``total_items`` counts non-NULL product ids.  Items of every delivered
    version are summed (reference parity; dedupe items first to avoid it).
    """
    q, up, cp, rate = F.col("quantity"), F.col("unit_price"), F.col("cost_price"), F.col("item_discount_rate")
    return items.groupBy("order_id").agg(
        F.count("product_id").alias("total_items"),
        F.sum(q).alias("total_quantity"),
        F.sum(q * up).cast("decimal(18,2)").alias("total_amount"),
        F.sum(q * cp).cast("decimal(18,2)").alias("total_cost"),
        F.sum(rate).cast("decimal(18,6)").alias("total_discount"),
        F.sum(q * up * (F.lit(1) - rate)).cast("decimal(18,2)").alias("line_revenue"),
        F.sum(q * cp).cast("decimal(18,2)").alias("line_cost"),
    )


def order_header_items(headers: DataFrame, rollup: DataFrame) -> DataFrame:
    """Every order header with its item totals (0 when it has no items)."""
    zero2 = F.lit(0).cast("decimal(18,2)")
    return (headers.join(rollup, "order_id", "left")
            .withColumns({
                "total_items": F.coalesce("total_items", F.lit(0).cast("bigint")),
                "total_quantity": F.coalesce("total_quantity", F.lit(0).cast("bigint")),
                "total_amount": F.coalesce("total_amount", zero2),
                "total_cost": F.coalesce("total_cost", zero2),
                "total_discount": F.coalesce("total_discount", F.lit(0).cast("decimal(18,6)")),
                "line_revenue": F.coalesce("line_revenue", zero2),
                "line_cost": F.coalesce("line_cost", zero2),
            }))


def with_order_metrics(orders: DataFrame, as_of) -> DataFrame:
    """M10-M15 on a header+totals table."""
    hour = F.hour("order_datetime")
    profit = M.order_profit("line_revenue", "order_discount_rate", "line_cost", "shipping_cost", "tax_amount")
    return orders.withColumns({
        "order_hour": hour,
        "order_time_of_day": M.time_of_day(hour),
        **M.calendar_parts("order_date", "order_"),
        "profit_amount": profit,
        "profit_margin_percentage": M.order_margin_pct(profit, "line_revenue"),
        "processing_days": M.days_between("order_date", "shipping_date"),
        "shipping_days": M.days_between("shipping_date", "delivery_date"),
        "delivery_status": M.delivery_status("delivery_date", "estimated_delivery_date", as_of),
    })


def silver_orders(headers: DataFrame, item_versions: DataFrame, as_of) -> DataFrame:
    return with_order_metrics(order_header_items(headers, order_rollup(item_versions)), as_of)

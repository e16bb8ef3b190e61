"""Campaign performance by campaign x day (fact_marketing_performance chain).

Operators: K1 A3 J2 M22 J6 P8 A4 A5 J5 J7 A6 P7 M23 M24.

Plan notes (identical results, cheaper plans):

* J5: the date window join is an expand-to-days + equi join, not a nested loop.
* J6/A4/A5: campaigns are a bounded dimension, broadcast behind a size check;
  the campaign x customer status is ONE aggregation of in-window sales
  (the distinct campaign_customers re-join is implied by it), and since that
  status is unique per (campaign, customer) the three distinct counts become
  ``count``/``sum`` with no Expand.
* J7/A6: sales are pre-aggregated per (campaign, day) before meeting the
  calendar; the window test is implied by the equal day.
* P7: ``NOT EXISTS (earlier sale of the customer before campaign start)`` is
  ``first purchase of the customer >= start``: an aggregate + equi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import metrics as M
from shelfspark.functions.keys import date_key, surrogate_key
from shelfspark.operators.joins import checked_broadcast, range_to_calendar

FACT_COLUMNS = ["marketing_performance_key", "campaign_key", "date_key", "campaign_id", "full_date",
                "total_sales_influenced", "new_customers_acquired", "repeat_purchase_rate",
                "total_campaign_cost", "roi"]


def sales_base(orders: DataFrame) -> DataFrame:
    """Campaign-attributed sales with surrogate keys (orders with an id and a campaign)."""
    return (orders.filter(F.col("order_id").isNotNull() & F.col("campaign_id").isNotNull())
            .select("order_id",
                    surrogate_key("campaign_id").alias("campaign_key"),
                    date_key("order_date").alias("date_key"),
                    surrogate_key("customer_id").alias("customer_key"),
                    "customer_id", "campaign_id", "order_date",
                    F.coalesce("total_amount", F.lit(0).cast("decimal(18,2)")).alias("total_sales_amount")))


def first_purchase(sales: DataFrame) -> DataFrame:
    """A3: first campaign-order date per (non-NULL) customer."""
    return (sales.filter(F.col("customer_id").isNotNull())
                 .groupBy("customer_id").agg(F.min("order_date").alias("first_purchase_date")))


def first_repeat_flags(sales: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """M22 + J8: is the sale on the customer's first day, or later.

    Sales without a customer are neither, and skip the join: as one join key
    they would all meet in one task.
    """
    first = first if first is not None else first_purchase(sales)
    named = sales.filter(F.col("customer_id").isNotNull()).join(first, "customer_id", "left")
    flagged = named.withColumns({
        "is_first_purchase": F.coalesce(F.col("order_date") == F.col("first_purchase_date"), F.lit(False)),
        "is_repeat_purchase": F.coalesce(F.col("order_date") > F.col("first_purchase_date"), F.lit(False)),
    }).drop("first_purchase_date")
    anonymous = sales.filter(F.col("customer_id").isNull()).withColumns({
        "is_first_purchase": F.lit(False), "is_repeat_purchase": F.lit(False)})
    return flagged.unionByName(anonymous)


def campaign_dim_slice(campaign_dim: DataFrame) -> DataFrame:
    return campaign_dim.select("campaign_key", "campaign_id", "budget", "start_date", "end_date")


def campaign_calendar(campaign_dim: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per campaign day that exists in the calendar."""
    cal = calendar.select("date_key", "full_date")
    return range_to_calendar(campaign_dim_slice(campaign_dim), cal, "start_date", "end_date").select(
        "campaign_key", "campaign_id", "budget", "start_date", "end_date", "date_key", "full_date")


def in_window_sales(campaign_dim: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """Sales joined to their campaign, inside the campaign window (equi + range)."""
    c = checked_broadcast(campaign_dim.select("campaign_key", F.col("campaign_id").alias("_cid"),
                                              "start_date", "end_date"))
    return (fact_sales.join(c, "campaign_key", "inner")
                      .filter(F.col("order_date").between(F.col("start_date"), F.col("end_date")))
                      .drop("_cid"))


def campaign_customers(campaign_dim: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """J6 + P8: distinct (campaign, customer) with an in-window sale."""
    return (in_window_sales(campaign_dim, fact_sales)
            .filter(F.col("customer_key").isNotNull())
            .select("campaign_key", "campaign_id", "customer_key", "customer_id", "start_date", "end_date")
            .distinct())


def campaign_customer_status(campaign_dim: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """A4: per campaign x customer, did an in-window sale count as first / repeat."""
    return (in_window_sales(campaign_dim, fact_sales)
            .filter(F.col("customer_key").isNotNull())
            .groupBy("campaign_key", "customer_key")
            .agg(F.max(F.when(F.col("is_first_purchase"), 1).otherwise(0)).alias("is_first_purchase"),
                 F.max(F.when(F.col("is_repeat_purchase"), 1).otherwise(0)).alias("is_repeat_purchase")))


def campaign_customer_metrics(status: DataFrame) -> DataFrame:
    """A5: customer counts per campaign (status is unique per campaign x customer)."""
    return status.groupBy("campaign_key").agg(
        F.count(F.lit(1)).alias("total_campaign_customers"),
        F.sum("is_first_purchase").cast("bigint").alias("first_purchase_customers"),
        F.sum("is_repeat_purchase").cast("bigint").alias("repeat_purchase_customers"))


def sales_influenced(calendar_days: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """J7 + A6: sales per campaign day, 0 when none."""
    daily = fact_sales.groupBy("campaign_key", "date_key").agg(F.sum("total_sales_amount").alias("_s"))
    return (calendar_days.select("campaign_key", "date_key").join(daily, ["campaign_key", "date_key"], "left")
            .select("campaign_key", "date_key",
                    F.coalesce("_s", F.lit(0).cast("decimal(18,2)")).cast("decimal(18,2)")
                     .alias("total_sales_influenced")))


def new_customers(calendar_days: DataFrame, fact_sales: DataFrame) -> DataFrame:
    """Per campaign day, distinct customers with no sale before the campaign start."""
    first_by_key = fact_sales.groupBy("customer_key").agg(F.min("order_date").alias("_first"))
    cd = calendar_days.select("campaign_key", "date_key", "start_date")
    day_customers = fact_sales.select("campaign_key", "date_key", "customer_key").distinct()
    j = (cd.join(day_customers, ["campaign_key", "date_key"], "inner")
           .join(first_by_key, "customer_key", "left"))
    new = j.filter(F.col("customer_key").isNotNull() & (F.col("_first") >= F.col("start_date")))
    counts = new.groupBy("campaign_key", "date_key").agg(F.count(F.lit(1)).alias("new_customers_acquired"))
    return (cd.select("campaign_key", "date_key").join(counts, ["campaign_key", "date_key"], "left")
              .withColumn("new_customers_acquired", F.coalesce("new_customers_acquired", F.lit(0).cast("bigint"))))


def fact_marketing_performance(campaign_dim: DataFrame, calendar: DataFrame, orders: DataFrame) -> DataFrame:
    fact_sales = first_repeat_flags(sales_base(orders))
    days = campaign_calendar(campaign_dim, calendar)
    metrics_c = campaign_customer_metrics(campaign_customer_status(campaign_dim, fact_sales))
    si = sales_influenced(days, fact_sales)
    nc = new_customers(days, fact_sales)
    # one metrics row per campaign that had in-window sales: bounded by the campaign dimension
    metrics_side = metrics_c
    m = (days.join(si, ["campaign_key", "date_key"], "left")
             .join(nc, ["campaign_key", "date_key"], "left")
             .join(metrics_side, "campaign_key", "left"))
    zero = F.lit(0).cast("bigint")
    m = m.withColumns({
        "total_sales_influenced": F.coalesce("total_sales_influenced", F.lit(0).cast("decimal(18,2)")),
        "new_customers_acquired": F.coalesce("new_customers_acquired", zero),
        "total_campaign_customers": F.coalesce("total_campaign_customers", zero),
        "repeat_purchase_customers": F.coalesce("repeat_purchase_customers", zero),
    })
    return m.select(
        surrogate_key("campaign_key", "date_key").alias("marketing_performance_key"),
        "campaign_key", "date_key", "campaign_id", "full_date", "total_sales_influenced",
        "new_customers_acquired",
        M.repeat_rate("repeat_purchase_customers", "total_campaign_customers").alias("repeat_purchase_rate"),
        F.col("budget").alias("total_campaign_cost"),
        M.roi("total_sales_influenced", "budget").alias("roi"),
    )

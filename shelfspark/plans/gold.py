"""Gold dimensions (date, campaign, product, store, supplier) and the inventory fact."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.functions import metrics as M
from shelfspark.functions.clean import blank_to_null, join_parts
from shelfspark.functions.keys import date_key, surrogate_key
from shelfspark.operators.dedup import latest_per_key
from shelfspark.operators.joins import star_lookup

DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "week", "day_of_week", "day_name",
                "holiday_flag", "season"]


def date_attributes(days: DataFrame, col: str = "full_date",
                    holidays: Sequence[_dt.date] = config.HOLIDAYS) -> DataFrame:
    """I11 + S18 + M31 attributes of a day column (day_of_week 0 = Sunday)."""
    d = F.col(col)
    return days.select(
        date_key(d).alias("date_key"), d.alias("full_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.weekofyear(d).alias("week"), (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_name"),
        M.holiday_flag(d, holidays).alias("holiday_flag"), M.season(d).alias("season"))


def date_spine(spark: SparkSession, start, end_exclusive) -> DataFrame:
    """One row per day in [start, end_exclusive)."""
    s = start if not isinstance(start, _dt.date) else F.lit(start)
    e = end_exclusive if not isinstance(end_exclusive, _dt.date) else F.lit(end_exclusive)
    return spark.range(1).select(
        F.explode(F.sequence(s, F.date_sub(e, 1), F.expr("interval 1 day"))).alias("full_date"))


def dim_date(spark: SparkSession, start=config.CALENDAR_START, end_exclusive=config.CALENDAR_END_EXCLUSIVE,
             holidays: Sequence[_dt.date] = config.HOLIDAYS) -> DataFrame:
    return date_attributes(date_spine(spark, start, end_exclusive), holidays=holidays)


def calendar_date_key(d, start=config.CALENDAR_START, end_exclusive=config.CALENDAR_END_EXCLUSIVE):
    """The ``date_key`` a LEFT JOIN to the generated calendar would return (NULL outside it).

    The calendar is a generated contiguous spine, so membership is a range
    test: this replaces a fact-side join with a projection.
    """
    c = F.col(d) if isinstance(d, str) else d
    return F.when((c >= F.lit(start)) & (c < F.lit(end_exclusive)), date_key(c))


def dim_marketing_campaign(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(
        surrogate_key("campaign_id").alias("campaign_key"), "campaign_id", "campaign_name",
        F.col("demographics").alias("target_audience_segment"), "budget",
        M.duration_days("start_date", "end_date").alias("duration"), "start_date", "end_date",
        *[F.col(c).alias(a) for c, a in (("total_cost", "total_cost"), ("total_revenue", "total_revenue"), ("roi_calculation", "roi"))
          if c in campaigns.columns])


def dim_products(history: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Latest snapshot per product (newest date first, NULL dates first as in the dialect)."""
    latest = latest_per_key(history, ["product_id"], [("source_snapshot_date", True, True), ("product_history_key", True, False)])
    return star_lookup(latest, [(suppliers, "supplier_id", ["supplier_name"])]).select(
        surrogate_key("product_id").alias("product_key"), "product_id", "product_name", "category",
        "subcategory", *[c for c in ("product_line", "brand", "color", "size") if c in latest.columns],
        "unit_price", "cost_price", "supplier_id", "supplier_name")


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.select(
        surrogate_key("store_id").alias("store_key"), "store_id", "store_name",
        (F.col("standardized_address") if "standardized_address" in stores.columns else
         join_parts(", ", "address_city", "address_state", "address_country")).alias("address"),
        "address_city", "address_state", "address_country", "opening_date",
        M.store_size_band("size_sq_ft").alias("size_category"))


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        surrogate_key("supplier_id").alias("supplier_key"), "supplier_id", "supplier_name",
        join_parts(" | ", blank_to_null("contact_person"), blank_to_null("email"), blank_to_null("phone"),
                   blank_to_null("address")).alias("contact_information"),
        "payment_terms", "supplier_type")


FACT_INVENTORY_COLUMNS = [
    "inventory_key", "product_key", "date_key", "store_key", "supplier_key", "beginning_stock",
    "purchased_quantity", "sold_quantity", "ending_stock", "inventory_value", "stock_turnover_ratio",
    "supplier_contribution_percentage", "snapshot_gap_flag", "snapshot_gap_days",
]


def fact_inventory(inventory: DataFrame, products: DataFrame, stores: DataFrame, suppliers: DataFrame,
                   calendar_start=config.CALENDAR_START,
                   calendar_end_exclusive=config.CALENDAR_END_EXCLUSIVE) -> DataFrame:
    """Natural keys -> surrogate keys (NULL when the dimension lacks the member)."""
    f = star_lookup(inventory, [(products, "product_id", ["product_key"]), (stores, "store_id", ["store_key"]),
                                (suppliers, "supplier_id", ["supplier_key"])])
    return with_calendar_key(f, calendar_start, calendar_end_exclusive).select(*FACT_INVENTORY_COLUMNS)


def with_calendar_key(inventory: DataFrame, start=config.CALENDAR_START,
                      end_exclusive=config.CALENDAR_END_EXCLUSIVE) -> DataFrame:
    return inventory.withColumn("date_key", calendar_date_key("inventory_date", start, end_exclusive))


def keyed_lookup(dim: DataFrame, natural: str, key: str, columns: Sequence[str] | None = None):
    """The lookup of ``key`` by ``natural``; with ``columns``, followed by theirs by ``key`` (joins are associative)."""
    keys = dim.select(natural, key)
    if columns is None:
        return keys, natural, [key]
    return star_lookup(keys, [(dim, key, columns)]), natural, [key, *columns]


def rows_by_key(dim: DataFrame, natural: str, key: str, columns: Sequence[str], out: str):
    """The lookup of ``key`` by ``natural``, with a list of the dimension's rows of that key as ``out``: the fact's rows are
    those of the key's lookup, and a lookup of ``columns`` by key is an explode of the list (outer)."""
    lists = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct(*columns)).alias(out))
    return star_lookup(dim.select(natural, key), [(lists, key, [out])]), natural, [key, out]

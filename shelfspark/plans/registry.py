"""Named queries over the test tables: one per operator of the inventory.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables.  Computed columns carry fixed names shared with the SQL oracle.
Money is decimal(18,2), counts bigint, ratios DOUBLE rounded to 6 places.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.functions import clean as S
from shelfspark.functions import metrics as M
from shelfspark.functions.keys import surrogate_key
from shelfspark.operators import checks as CH
from shelfspark.operators.declared import run_declared
from shelfspark.operators.dedup import latest_per_key
from shelfspark.operators.history import scd2_apply, scd2_build
from shelfspark.operators.incremental import after_high_watermark, merge_upsert, new_rows
from shelfspark.operators.joins import flatten_items, star_lookup
from shelfspark.operators.load_log import log_entries, new_rows_logged
from shelfspark.operators.windows import with_previous_segmented
from shelfspark.plans import campaign as C
from shelfspark.plans import gold as G
from shelfspark.plans import inventory as I
from shelfspark.plans import orders as O
from shelfspark.plans import reports as RP
from shelfspark.plans.checks import DECLARED
from shelfspark.plans.mart import Mart
from shelfspark.session import ensure_checkpoint_dir
from shelfspark.sources import tpch_roles as R
from shelfspark.sources.freshness import freshness
from shelfspark.sources.landing import to_bronze
from shelfspark.sources.partitioned import PartitionedTable
from shelfspark.sources.sinks import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]

# FIXED VALUES: split points of the simulated increments (dates).
INCREMENT_TARGET_BEFORE = _dt.date(1998, 6, 30)
MERGE_TARGET_BEFORE = _dt.date(1999, 1, 1)
MERGE_INCOMING_FROM = _dt.date(1998, 1, 1)
WATERMARK_TARGET_UNTIL = _dt.date(1999, 12, 31)
FRESHNESS_EVENTS_AS_OF = _dt.datetime(2024, 1, 31, 12, 0, 0)
FRESHNESS_ORDERS_AS_OF = _dt.datetime(2001, 8, 2, 12, 0, 0)

_MARTS: dict[tuple[str, str], Mart] = {}


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MARTS:
        _MARTS[key] = Mart(spark, sf_dir)
    return _MARTS[key]


def _r6(c):
    return F.round(c.cast("double"), 6)


# ---------------------------------------------------------------------------
# ingestion
# ---------------------------------------------------------------------------

def bronze(spark, d) -> DataFrame:
    m = mart(spark, d)
    return to_bronze(R.order_landing(m.t), "$.order_id", "order_id", R.FIXTURE_RUN_ID, R.FIXTURE_LOADED_AT)


def q_bronze_extract(spark, d):
    return bronze(spark, d)


def q_json_extract(spark, d):
    m = mart(spark, d)
    v = F.col("value")
    return R.order_landing(m.t).select(
        S.json_field(v, "$.order_id").alias("order_id"),
        S.json_path(v, "$.customer_id", "bigint").alias("customer_id"),
        S.parse_date(S.json_text(v, "$.order_date")).alias("order_date"),
        S.json_field(v, "$.order_status").alias("order_status"),
        S.parse_money(S.json_text(v, "$.total_price")).alias("total_price"),
        S.json_field(v, "$.meta.priority").alias("priority"),
        S.json_path(v, "$.meta.clerk_no", "int").alias("clerk_no"),
        S.json_field(v, "$.tags[1]").alias("second_tag"),
        S.json_field(v, "$.missing.path").alias("missing_value"))


def q_flatten_items(spark, d):
    m = mart(spark, d)
    v = F.col("value")
    orders = R.order_landing(m.t).select(
        S.json_field(v, "$.order_id").alias("order_id"),
        F.try_variant_get(v, "$.order_items", "array<variant>").alias("order_items"))
    flat = flatten_items(orders, "order_items", "item_data", "item_number")
    return flat.select(
        "order_id", F.col("item_number").cast("int").alias("item_number"),
        S.json_field("item_data", "$.product_id").alias("product_id"),
        F.coalesce(S.parse_number(S.json_text("item_data", "$.quantity")), F.lit(0).cast("bigint")).alias("quantity"))


def q_incremental_anti_join(spark, d):
    b = bronze(spark, d)
    target = b.filter(S.file_date("_source_file") < F.lit(INCREMENT_TARGET_BEFORE))
    return new_rows(b, target, ["order_id", "_source_file"]).select("order_id", "_source_file")


def q_merge_upsert(spark, d):
    h = mart(spark, d).headers
    target = (h.filter(F.col("order_date") < F.lit(MERGE_TARGET_BEFORE))
               .select("order_id", F.lit("Pending").alias("order_status"), F.lit("v1").alias("version")))
    incoming = (h.filter(F.col("order_date") >= F.lit(MERGE_INCOMING_FROM))
                 .select("order_id", "order_status", F.lit("v2").alias("version")))
    return merge_upsert(target, incoming, ["order_id"])


def q_logged_anti_join(spark, d):
    """The anti join by the log of loaded files; every tenth order or so of the loaded files is not in the target."""
    b = cut_lineage(bronze(spark, d))
    held = b.filter((S.file_date("_source_file") < F.lit(INCREMENT_TARGET_BEFORE)) & ~F.col("order_id").endswith("7"))
    keys = ["order_id", "_source_file"]
    log = log_entries(held, keys, "_source_file", "first")
    return new_rows_logged(b, log, lambda loads: held, keys, "_source_file").select(*keys)


def q_partitioned_merge(spark, d):
    """The merge on a table partitioned by month; ``load_no`` 1: the row's file is that of the first load."""
    h = mart(spark, d).headers
    month = F.date_format("order_date", "yyyy-MM")
    first = (h.filter(F.col("order_date") < F.lit(MERGE_TARGET_BEFORE))
              .select("order_id", "order_date", F.lit("Pending").alias("order_status"), F.lit("v1").alias("version")))
    incoming = (h.filter((F.col("order_date") >= F.lit(MERGE_INCOMING_FROM)) & (F.col("order_id") % 10 != 3))
                 .select("order_id", "order_date", "order_status", F.lit("v2").alias("version")))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/partitioned-merge-{uuid.uuid4().hex}"
    one = PartitionedTable(spark, base).append(first, month, "1")
    two = one.merge(incoming, ["order_id", "order_date"], month)
    old, new = two.read(loads=["1"]), two.read(loads=[x for x in two.loads() if x != "1"])
    return old.withColumn("load_no", F.lit(1)).unionByName(new.withColumn("load_no", F.lit(2)))


def q_high_watermark_filter(spark, d):
    hist = mart(spark, d).history.select("product_id", "source_snapshot_date", "stock_quantity")
    target = hist.filter(F.col("source_snapshot_date") <= F.lit(WATERMARK_TARGET_UNTIL))
    return after_high_watermark(hist, target, "source_snapshot_date")


def q_source_freshness(spark, d):
    m = mart(spark, d)
    ev = freshness(m.t.events, "ts", "events", FRESHNESS_EVENTS_AS_OF)
    od = freshness(m.t.orders, F.col("o_orderdate"), "orders", FRESHNESS_ORDERS_AS_OF)
    return ev.unionByName(od)


# ---------------------------------------------------------------------------
# history
# ---------------------------------------------------------------------------

def q_latest_per_key(spark, d):
    v = mart(spark, d).item_versions
    return latest_per_key(v, ["order_id", "item_number"], R.ITEM_VERSION_ORDER).select(
        "order_id", "item_number", "product_id", "supplier_id", "quantity", "unit_price", "version_date")


def q_scd2_history(spark, d):
    v = mart(spark, d).item_versions
    hist = scd2_build(v, ["order_id", "item_number"], "version_date", R.ITEM_VERSION_ORDER[1:])
    return hist.select("order_id", "item_number", "product_id", "quantity", "scd_id", "valid_from", "valid_to",
                       "is_current")


def q_snapshot_apply(spark, d):
    """Two successive deliveries through the snapshot run; one row in thirteen is undated."""
    v = mart(spark, d).item_versions
    undated = (F.col("order_id") + F.col("product_id")) % 13 == 0
    second = F.col("version_date") >= F.lit(_dt.date(1998, 1, 1))
    dated = F.when(~undated, F.col("version_date"))
    deliveries = [v.filter(part).withColumn("version_date", dated) for part in (~second, second)]
    keys, order = ["order_id", "item_number"], [("version_date", True, True), *R.ITEM_VERSION_ORDER[1:]]
    hist = None
    for delivery in deliveries:
        hist = scd2_apply(hist, delivery, keys, "version_date", order)
    return hist.select("order_id", "item_number", "product_id", "quantity", "scd_id", "valid_from", "valid_to",
                       "is_current")


def q_scd2_composite_key(spark, d):
    h = mart(spark, d).history.withColumn(
        "scd_key", F.concat(F.col("product_id").cast("string"), F.lit("|"), F.col("source_snapshot_date").cast("string")))
    hist = scd2_build(h, "scd_key", "source_snapshot_date")
    return hist.select("scd_key", "product_id", "source_snapshot_date", "stock_quantity", "scd_id", "valid_from",
                       "valid_to", "is_current")


# ---------------------------------------------------------------------------
# cleaning
# ---------------------------------------------------------------------------

def q_blank_to_null(spark, d):
    m = mart(spark, d)
    return m.suppliers.select("supplier_id", S.blank_to_null("email").alias("email"),
                              S.blank_to_null("address").alias("address"))


def q_full_name(spark, d):
    c = mart(spark, d).customers
    return c.select("customer_id", S.full_name("first_name", "last_name").alias("full_name"),
                    S.full_name("first_name", "last_name", strict=True).alias("full_name_strict"))


def q_hierarchy_path(spark, d):
    m = mart(spark, d)
    return m.suppliers.select(
        "supplier_id",
        S.join_parts(" | ", S.blank_to_null("contact_person"), S.blank_to_null("email"), S.blank_to_null("phone"),
                     S.blank_to_null("address")).alias("contact_information"),
        S.join_parts(" | ", S.blank_to_null("contact_person"), S.blank_to_null("email"), S.blank_to_null("phone"),
                     S.blank_to_null("address"), on_null="skip").alias("contact_information_skip"))


def q_title_case(spark, d):
    c = mart(spark, d).customers
    return c.select("customer_id", S.title_case("display_name").alias("display_name"),
                    S.title_case(F.lower("email")).alias("email_title"))


def q_parse_money(spark, d):
    c = mart(spark, d).customers
    return c.select("customer_id", "account_balance_text",
                    S.parse_money("account_balance_text").alias("account_balance"))


def q_parse_number(spark, d):
    li = mart(spark, d).t.lineitem
    text = F.when(F.col("l_linenumber") % 7 == 0, F.lit("n/a")) \
            .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item_number"),
                     text.alias("amount_text"), S.parse_number(text).alias("amount_number"))


def q_normalize_phone(spark, d):
    c = mart(spark, d).customers
    return c.select("customer_id", "phone", S.digits("phone").alias("phone_digits"),
                    S.phone("phone", exact=10).alias("phone_exact10"),
                    S.phone("phone", exact=None, minimum=10).alias("phone_min10"),
                    S.phone_valid("phone").alias("phone_valid"))


def q_file_date(spark, d):
    b = bronze(spark, d)
    return b.select("order_id", "_source_file", S.file_date("_source_file").alias("source_snapshot_date"),
                    S.file_date("_source_file", config.SUPPLIER_FILE_DATE_PATTERN).alias("supplier_snapshot_date"))


def q_validate_email(spark, d):
    c = mart(spark, d).customers
    return c.select("customer_id", S.valid_email("email").alias("email_id"),
                    S.email_valid_flag("email").alias("email_valid"),
                    S.valid_email("email", lenient=True).alias("email_id_lenient"),
                    S.email_valid_flag("email", lenient=True).alias("email_valid_lenient"))


def q_surrogate_key(spark, d):
    v = mart(spark, d).item_versions
    part = F.when(F.col("item_number") % 5 != 0, F.col("item_number"))
    return v.select("order_id", "item_number", surrogate_key("order_id", "item_number").alias("order_item_key"),
                    surrogate_key("order_id", part).alias("partial_key"))


def q_name_cleaning(spark, d):
    """S8 (the rules of customers, products, product history and stores) and S16 (boolean words) over every customer."""
    c = mart(spark, d).customers
    k = F.col("customer_id") % 5
    flag_text = (F.when(k == 0, F.lit("ON")).when(k == 1, F.lit(" yes")).when(k == 2, F.lit("False"))
                  .when(k == 3, F.lit("maybe")).otherwise(F.lit("")))
    return c.select("customer_id",
                    S.clean_name("display_name").alias("customer_name"),
                    S.clean_name("display_name", "A-Za-z0-9' -").alias("product_name"),
                    S.clean_name("display_name", "A-Za-z0-9", strip_first=False).alias("history_name"),
                    S.clean_name("display_name", "A-Za-z0-9' -", strip_first=False).alias("store_name"),
                    flag_text.alias("opt_in_text"), S.parse_bool(flag_text).alias("marketing_opt_in"))


def q_typed_parsing(spark, d):
    """S13 (zoned instant vs wall clock) and S14 (decimal text) over every event."""
    ev = mart(spark, d).t.events
    zoned = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00"))
    amount = F.concat((F.col("event_id") % 1000).cast("string"), F.lit("."),
                      F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"))
    local = S.parse_ts(F.regexp_replace(zoned, r"[+-]\d\d:\d\d$", ""))
    return ev.select("event_id", F.hour(S.parse_ts(zoned, zoned=True)).alias("utc_hour"),
                     F.hour(local).alias("local_hour"), amount.alias("amount_text"),
                     S.parse_decimal(amount, 18, 2).alias("amount"))


def q_percent_rate(spark, d):
    """Percent text to a rate, over every item: padded, blank, junk and missing texts."""
    li = mart(spark, d).t.lineitem
    pct = F.concat((F.col("l_partkey") % 100).cast("string"), F.lit("."),
                   F.lpad(((F.col("l_suppkey") * 7919) % 1000000).cast("string"), 6, "0"))
    kind = F.col("l_orderkey") % 6
    text = (F.when(kind == 0, F.lit("  ")).when(kind == 1, F.concat(F.lit(" "), pct, F.lit(" ")))
             .when(kind == 2, F.lit("n/a")).when(kind == 3, F.lit(None)).otherwise(pct))
    return (li.select("l_orderkey", "l_linenumber", text.alias("percent_text"))
              .withColumn("rate", S.percent_to_rate("percent_text")))


def q_order_window_days(spark, d):
    """M1: days from order to delivery when both are set and not reversed."""
    h = mart(spark, d).headers
    return h.select("order_id", M.duration_days("order_date", "delivery_date").alias("order_to_delivery_days"),
                    M.duration_days("delivery_date", "order_date").alias("reversed_days"))


# ---------------------------------------------------------------------------
# orders
# ---------------------------------------------------------------------------

def q_order_rollup(spark, d):
    return O.order_rollup(mart(spark, d).item_versions)


def q_order_header_items(spark, d):
    o = mart(spark, d).orders
    return o.select("order_id", "customer_id", "store_id", "order_status", "total_items", "total_quantity",
                    "total_amount", "total_cost", "total_discount", "line_revenue", "line_cost")


def q_order_profitability(spark, d):
    o = mart(spark, d).orders
    return o.select("order_id", "line_revenue", "order_discount_rate", "line_cost", "shipping_cost", "tax_amount",
                    "profit_amount", "profit_margin_percentage")


def q_time_of_day(spark, d):
    ev = mart(spark, d).t.events
    hour = F.hour("ts")
    return ev.select("event_id", hour.alias("event_hour"), M.time_of_day(hour).alias("time_of_day"))


def q_calendar_parts(spark, d):
    ev = mart(spark, d).t.events
    parts = M.calendar_parts(F.to_date("ts"), "event_")
    return ev.select("event_id", *[c.alias(n) for n, c in parts.items()])


def q_delivery_status(spark, d):
    o = mart(spark, d).orders
    return o.select("order_id", "order_date", "shipping_date", "delivery_date", "estimated_delivery_date",
                    "processing_days", "shipping_days", "delivery_status")


def q_profit_margin(spark, d):
    h = mart(spark, d).history
    return h.select("product_id", "source_snapshot_date", "unit_price", "cost_price",
                    M.margin_pct("unit_price", "cost_price", decimal_scale=None, round_to=6)
                    .alias("profit_margin_percentage"),
                    M.low_stock("stock_quantity", "reorder_level").alias("low_stock_flag"),
                    M.low_stock("stock_quantity", F.when(F.col("reorder_level") > 10, F.col("reorder_level")),
                                on_null=None).alias("low_stock_nullable"))


# ---------------------------------------------------------------------------
# entities
# ---------------------------------------------------------------------------

def q_age_bands(spark, d):
    c = mart(spark, d).customers
    age = M.whole_years("birth_date", R.FIXTURE_AS_OF)
    return c.select("customer_id", "birth_date", age.alias("customer_age"), M.age_band(age).alias("customer_segment"))


def q_size_bands(spark, d):
    s = mart(spark, d).stores
    return s.select("store_id", "size_sq_ft", M.store_size_band("size_sq_ft").alias("store_size_category"),
                    M.whole_years("opening_date", R.FIXTURE_AS_OF).alias("store_age_years"))


def q_store_performance(spark, d):
    s = mart(spark, d).stores
    ach = M.target_achievement_pct("current_sales", "sales_target", decimal_scale=2)
    return s.select("store_id", "current_sales", "sales_target",
                    ach.alias("sales_target_achievement_percentage"),
                    M.safe_ratio("current_sales", "size_sq_ft", 1.0, round_to=6).alias("revenue_per_sq_ft"),
                    M.safe_ratio("current_sales", "employee_count", 1.0, round_to=6).alias("employee_efficiency"),
                    M.performance_issue(ach).alias("performance_issue_flag"))


def q_date_dimension(spark, d):
    m = mart(spark, d)
    lo = m.t.orders.agg(F.min(F.to_date("o_orderdate"))).scalar()
    hi = m.t.lineitem.agg(F.date_add(F.max(F.to_date("l_shipdate")), 1)).scalar()
    return G.date_attributes(G.date_spine(spark, lo, hi))


# ---------------------------------------------------------------------------
# inventory
# ---------------------------------------------------------------------------

def q_distinct_relationship(spark, d):
    return I.product_store(mart(spark, d).items)


def q_inventory_fanout(spark, d):
    m = mart(spark, d)
    return I.fan_out(I.stock_snapshots(m.history), I.product_store(m.items)).select(
        "product_id", "store_id", "inventory_date", "ending_stock")


def q_beginning_stock(spark, d):
    m = mart(spark, d)
    return I.fan_out(I.stock_snapshots(m.history), I.product_store(m.items)).select(
        "product_id", "store_id", "inventory_date", "beginning_stock", "ending_stock")


def q_segmented_previous(spark, d):
    """W2 / W4 with a product's snapshots cut by month, for products with more of them than a task should sort."""
    hist = mart(spark, d).history.select("product_id", "source_snapshot_date", "stock_quantity")
    return with_previous_segmented(
        hist, ["product_id"], [("source_snapshot_date", False, False)],
        {"stock_quantity": "previous_stock", "source_snapshot_date": "previous_date"}, F.trunc("source_snapshot_date", "MM"))


def q_completed_sales(spark, d):
    return I.completed_sales(mart(spark, d).items)


def q_inventory_movement(spark, d):
    inv = mart(spark, d).inventory
    return inv.select("inventory_key", "product_id", "store_id", "inventory_date", "beginning_stock",
                      "purchased_quantity", "sold_quantity", "ending_stock", "inventory_value",
                      "stock_turnover_ratio", "low_stock_flag", "negative_inferred_purchase_flag")


def q_contribution_share(spark, d):
    inv = mart(spark, d).inventory
    return inv.select("product_id", "store_id", "inventory_date", "purchased_quantity",
                      "supplier_contribution_percentage")


def q_snapshot_gap(spark, d):
    inv = mart(spark, d).inventory
    return inv.select("product_id", "store_id", "inventory_date", "snapshot_gap_flag", "snapshot_gap_days")


def q_stock_turnover(spark, d):
    inv = mart(spark, d).inventory
    return inv.select("product_id", "store_id", "inventory_date", "sold_quantity",
                      _r6(M.average_inventory("beginning_stock", "ending_stock")).alias("average_inventory"),
                      "stock_turnover_ratio")


def q_star_lookup(spark, d):
    return mart(spark, d).fact_inventory


# ---------------------------------------------------------------------------
# campaign
# ---------------------------------------------------------------------------

def q_first_purchase(spark, d):
    return C.first_purchase(C.sales_base(mart(spark, d).orders))


def q_first_repeat_flags(spark, d):
    fs = mart(spark, d).fact_sales
    return fs.select("order_id", "customer_id", "order_date", "is_first_purchase", "is_repeat_purchase")


def q_campaign_calendar(spark, d):
    return mart(spark, d).campaign_days


def q_campaign_customers(spark, d):
    m = mart(spark, d)
    return C.campaign_customers(m.dim_campaign, m.fact_sales)


def q_campaign_customer_status(spark, d):
    m = mart(spark, d)
    return C.campaign_customer_status(m.dim_campaign, m.fact_sales)


def q_sales_influenced(spark, d):
    m = mart(spark, d)
    return C.sales_influenced(m.campaign_days, m.fact_sales)


def q_new_customers_acquired(spark, d):
    m = mart(spark, d)
    return C.new_customers(m.campaign_days, m.fact_sales)


def q_repeat_purchase_rate(spark, d):
    f = mart(spark, d).fact_marketing
    return f.select("campaign_key", "date_key", "repeat_purchase_rate")


def q_campaign_roi(spark, d):
    return mart(spark, d).fact_marketing


# ---------------------------------------------------------------------------
# reports
# ---------------------------------------------------------------------------

def q_inventory_valuation(spark, d):
    m = mart(spark, d)
    fact = m.fact_with(["product_name", "category", "subcategory"], ["store_name"], ["supplier_name"])
    return RP.valuation_rows(star_lookup(fact, [(m.dim_date, "date_key", ["full_date"])]))


def q_turnover_category(spark, d):
    m = mart(spark, d)
    fact = m.fact_with(["product_name", "category", "subcategory"], ["store_name"])
    return RP.turnover_rows(star_lookup(fact, [(m.dim_date, "date_key", ["full_date"])]))


def q_movement_quartiles(spark, d):
    m = mart(spark, d)
    return RP.slow_vs_fast_moving(cut_lineage(RP.product_totals(m.fact_inventory)), m.dim_products)


def q_ontime_vs_delayed(spark, d):
    m = mart(spark, d)
    fact = m.fact_with(cluster_by={"supplier_key": F.col("supplier_key"), "_year": F.year("inventory_date")}, supplier_rows=RP.SUPPLIER_COLUMNS)
    return RP.ontime_vs_delayed(fact, m.dim_date, m.dim_stores, m.dim_suppliers, ["_year"], "_suppliers")


def q_supplier_concentration_risk(spark, d):
    m = mart(spark, d)
    return RP.supplier_concentration_risk(m.fact_inventory, m.dim_suppliers)


def q_supplier_category_contribution(spark, d):
    m = mart(spark, d)
    # dealt by the product's id, with which its key goes: summed and looked up where the rows are
    per = m.fact_with().groupBy("_product_id", "supplier_key", "product_key").agg(
        F.sum("purchased_quantity").alias("supplier_purchased_quantity"))
    products = m.dim_products.select(F.col("product_id").alias("_product_id"), "category")
    per = star_lookup(per, [(products, "_product_id", ["category"])])
    return RP.contribution_rows(per, m.dim_suppliers)


def q_engagement_metrics(spark, d):
    m = mart(spark, d)
    return RP.engagement_metrics(m.fact_marketing, m.dim_campaign)


def q_roi_by_segment(spark, d):
    m = mart(spark, d)
    return RP.roi_by_segment(m.fact_marketing, m.dim_campaign)


def q_sales_impact(spark, d):
    m = mart(spark, d)
    return RP.sales_impact(m.fact_marketing, m.dim_campaign, m.dim_date)


# ---------------------------------------------------------------------------
# checks
# ---------------------------------------------------------------------------

def q_check_not_null(spark, d):
    m = mart(spark, d)
    return CH.run_checks([
        CH.check_not_null(m.fact_inventory, ["inventory_key", "product_key", "date_key", "store_key", "supplier_key"],
                          "fact_inventory"),
        CH.check_not_null(m.items, ["order_item_key", "order_id", "product_id", "store_id"], "silver_order_items"),
        CH.check_not_null(m.fact_marketing, ["marketing_performance_key", "campaign_key", "date_key"],
                          "fact_marketing_performance"),
    ])


def q_check_unique(spark, d):
    m = mart(spark, d)
    return CH.run_checks([
        CH.check_unique(m.fact_inventory, "inventory_key", "fact_inventory"),
        CH.check_unique(m.sold_items, "order_item_key", "silver_order_items"),
        CH.check_unique(m.history, "product_history_key", "silver_product_history"),
        CH.check_unique(m.dim_products, "product_key", "dim_products"),
        CH.check_unique(m.fact_marketing, "marketing_performance_key", "fact_marketing_performance"),
        CH.check_unique(R.item_versions(m.t).withColumn("k", surrogate_key("order_id", "item_number")), "k",
                        "item_versions"),
    ])


def q_dim_products(spark, d):
    return mart(spark, d).dim_products


def q_dim_stores(spark, d):
    return mart(spark, d).dim_stores


def q_dim_suppliers(spark, d):
    return mart(spark, d).dim_suppliers


def q_dim_marketing_campaign(spark, d):
    return mart(spark, d).dim_campaign


def q_check_relationships(spark, d):
    m = mart(spark, d)
    f = m.fact_inventory
    return CH.run_checks([
        CH.check_relationships(f, "product_key", m.dim_products, "product_key", "fact_inventory"),
        CH.check_relationships(f, "store_key", m.dim_stores, "store_key", "fact_inventory"),
        CH.check_relationships(f, "supplier_key", m.dim_suppliers, "supplier_key", "fact_inventory"),
        CH.check_relationships(f, "date_key", m.dim_date, "date_key", "fact_inventory"),
        CH.check_relationships(m.fact_marketing, "campaign_key", m.dim_campaign, "campaign_key",
                               "fact_marketing_performance"),
        CH.check_relationships(m.items, "customer_id", m.customers, "customer_id", "silver_order_items"),
    ])


def q_declared_checks(spark, d):
    m = mart(spark, d)
    tables = {
        "silver_customers": m.customers, "silver_product_history": m.history, "silver_order_items": m.sold_items,
        "silver_orders": m.orders, "silver_stores": m.stores, "silver_suppliers": m.suppliers,
        "silver_campaigns": m.campaigns, "silver_inventory": m.inventory, "dim_date": m.dim_date,
        "dim_marketing_campaign": m.dim_campaign, "dim_products": m.dim_products, "dim_stores": m.dim_stores,
        "dim_suppliers": m.dim_suppliers, "fact_inventory": m.fact_inventory, "fact_marketing_performance": m.fact_marketing,
    }
    # read twice: the small derived tables' checked columns are written once, the fanned-out rows never
    for name in ("dim_products", "fact_marketing_performance"):
        tables[name] = cut_lineage(tables[name].select(*sorted({c.column for c in DECLARED if c.table == name})))
    return run_declared(tables, DECLARED)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

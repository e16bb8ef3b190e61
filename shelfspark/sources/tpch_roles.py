"""Retail roles derived from the TPC-H-style test tables.

The test data is not retail JSON, so each silver-level role is derived from
the driver tables by a fixed rule.  Every rule is integer / decimal exact
(no double -> decimal casts of inexact values) so an independent SQL oracle
reproduces it bit for bit.

| role                 | derived from                                             |
| -------------------- | -------------------------------------------------------- |
| order header         | orders + customer (store = customer nation)              |
| order item (versions)| lineitem rows; (l_orderkey, l_linenumber) repeats        |
| product snapshot     | lineitem by (part, ship date) + part                     |
| store                | nation + region, sales from orders                       |
| supplier             | supplier                                                 |
| customer             | customer                                                 |
| campaign             | order priorities, windows from each one's first order |
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.keys import surrogate_key
from shelfspark.operators.dedup import latest_per_key, newest_rows

# ---------------------------------------------------------------------------
# FIXED VALUES for the test-data roles
# ---------------------------------------------------------------------------

# Campaigns: one per order priority (campaign_id, name, start in days after the priority's first order, length in days,
# budget, demographics).
FIXTURE_CAMPAIGNS = (
    ("1-URGENT", "Spring Rush", 31, 88, "150000.00", '{"segment":"young_adults"}'),
    ("2-HIGH", "Summer Saver", 517, 91, "90000.00", '{"segment":"families"}'),
    ("3-MEDIUM", "Year of Value", 1096, 364, "400000.00", '{"segment":"families"}'),
    ("4-NOT SPECIFIED", "Flash Weeks", 1900, 61, "0.00", '{"segment":"seniors"}'),
    ("5-LOW", "Next Year Teaser", 2557, 89, "50000.00", '{"segment":"seniors"}'),
)

# Calendar used by the facts built on the test data (the data spans 1995-2001).
FIXTURE_CALENDAR_START = _dt.date(1995, 1, 1)
FIXTURE_CALENDAR_END_EXCLUSIVE = _dt.date(2002, 1, 1)

# "Today" for age, delivery and store-age rules on the test data.
FIXTURE_AS_OF = _dt.date(2001, 6, 30)

# Order status letters.
FIXTURE_STATUS = (("F", "Delivered"), ("P", "Completed"), ("O", "Pending"))

# Supplier types by nation key modulo 3.
FIXTURE_SUPPLIER_TYPES = ("Manufacturer", "Distributor", "Wholesaler")

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES or name in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
            return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
        raise AttributeError(name)


def _status(code: Column) -> Column:
    out = None
    for letter, label in FIXTURE_STATUS:
        out = F.when(code == letter, F.lit(label)) if out is None else out.when(code == letter, F.lit(label))
    return out


# ---------------------------------------------------------------------------
# orders
# ---------------------------------------------------------------------------

def order_headers(t: Tables) -> DataFrame:
    """Order header role: one row per order, store = the customer's nation."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey"))
    h = o.join(c, "o_custkey", "left")
    order_date = F.to_date("o_orderdate")
    return h.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_nationkey").cast("bigint").alias("store_id"),
        F.col("o_orderpriority").alias("campaign_id"),
        F.col("o_orderdate").alias("order_datetime"),
        order_date.alias("order_date"),
        F.date_add(order_date, (F.col("o_orderkey") % 5).cast("int")).alias("shipping_date"),
        F.when(F.col("o_orderstatus") == "F",
               F.date_add(order_date, (F.col("o_orderkey") % 11).cast("int"))).alias("delivery_date"),
        F.date_add(order_date, 7).alias("estimated_delivery_date"),
        _status(F.col("o_orderstatus")).alias("order_status"),
        F.expr("cast(cast(o_orderkey % 4 as decimal(18,6)) * 0.01 as decimal(18,6))").alias("order_discount_rate"),
        (F.col("o_orderkey") % 50).cast("decimal(18,2)").alias("shipping_cost"),
        (F.col("o_custkey") % 20).cast("decimal(18,2)").alias("tax_amount"),
    )


_UNIT_PRICE = ("cast(cast(cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)"
               " as decimal(18,0)) * 0.01 as decimal(18,2))")

# Tie-break order that makes every item version unique (newest first).
ITEM_VERSION_ORDER = [
    ("version_date", True, False), ("product_id", True, False), ("supplier_id", True, False),
    ("quantity", True, False), ("l_extendedprice", True, False), ("l_discount", True, False),
    ("l_tax", True, False), ("l_returnflag", True, False), ("l_linestatus", True, False),
]


def item_versions(t: Tables) -> DataFrame:
    """Every delivered version of an order item (lineitem rows), without header fields."""
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("item_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.expr(_UNIT_PRICE).alias("unit_price"),
        F.expr(f"cast({_UNIT_PRICE} * 0.75 as decimal(18,2))").alias("cost_price"),
        F.col("l_discount").cast("decimal(18,6)").alias("item_discount_rate"),
        F.to_date("l_shipdate").alias("version_date"),
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )


ITEM_COLUMNS = ["order_id", "item_number", "product_id", "supplier_id", "quantity", "unit_price",
                "cost_price", "item_discount_rate", "version_date"]


# Columns by which the newest version is found and which have the same values in all versions that tie in them.
SOLD_COLUMNS = ["version_date", "product_id", "supplier_id", "quantity"]


def order_items(t: Tables, headers: DataFrame | None = None, priced: bool = True) -> DataFrame:
    """Silver order items: newest version per (order, item) + header fields + item key.

    Without prices (``priced``) the order ends with the last column kept: versions that tie until there differ in prices,
    discounts and flags only, so any of them gives the same row, and the columns behind aren't shuffled.
    """
    order = ITEM_VERSION_ORDER if priced else [o for o in ITEM_VERSION_ORDER if o[0] in SOLD_COLUMNS]
    latest = latest_per_key(item_versions(t), ["order_id", "item_number"], order)
    h = (headers if headers is not None else order_headers(t)).select(
        "order_id", "order_date", "order_status", "customer_id", "store_id")
    kept = ITEM_COLUMNS if priced else [c for c in ITEM_COLUMNS if c in ("order_id", "item_number", *SOLD_COLUMNS)]
    return (latest.select(*kept).join(h, "order_id", "left")
                  .withColumn("order_item_key", surrogate_key("order_id", "item_number")))


# ---------------------------------------------------------------------------
# products, stores, suppliers, customers, campaigns
# ---------------------------------------------------------------------------

def product_snapshots(t: Tables, newest: bool = False) -> DataFrame:
    """Stock and supplier per (part, ship date); ``newest``: only each product's newest ones (NULL dates first)."""
    rows = t.lineitem.select(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("source_snapshot_date"),
                             "l_quantity", "l_suppkey")
    return ((newest_rows(rows, "product_id", "source_snapshot_date") if newest else rows)
            .groupBy("product_id", "source_snapshot_date")
            .agg(F.sum("l_quantity").cast("bigint").alias("stock_quantity"),
                 F.min("l_suppkey").alias("supplier_id")))


def product_attributes(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
        F.col("p_size").cast("bigint").alias("reorder_level"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("cost_price"))


def product_history(t: Tables, newest: bool = False) -> DataFrame:
    """Product snapshot role: stock per (part, ship date), attributes from part.

    ``newest``: only each product's newest snapshots, found before they are widened by the part.
    """
    return (product_snapshots(t, newest).join(product_attributes(t), "product_id", "left")
                 .withColumn("unit_price", F.expr("cast(cost_price * 1.25 as decimal(18,2))"))
                 .withColumn("product_history_key", surrogate_key("product_id", "source_snapshot_date")))


def stores(t: Tables) -> DataFrame:
    """Store role: one per nation; sales from the orders of the nation's customers."""
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    region = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name"))
    sales = (t.orders.select("o_custkey", "o_totalprice")
             .join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
             .groupBy(F.col("c_nationkey").alias("n_nationkey"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("current_sales")))
    base = (nation.join(F.broadcast(region), "n_regionkey", "left")
                  .join(sales, "n_nationkey", "left")
                  .withColumn("current_sales", F.coalesce("current_sales", F.lit(0).cast("decimal(18,2)"))))
    targets = base.groupBy("n_regionkey").agg(
        F.expr("cast(max(current_sales) * 0.95 as decimal(18,2))").alias("sales_target"))
    return base.join(targets, "n_regionkey", "left").select(
        F.col("n_nationkey").cast("bigint").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("r_name").alias("address_state"),
        F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("address_city"),
        F.lit("US").alias("address_country"),
        (F.lit(2000) + F.col("n_nationkey") * 500).cast("bigint").alias("size_sq_ft"),
        (F.lit(5) + F.col("n_nationkey")).cast("bigint").alias("employee_count"),
        F.date_add(F.lit(_dt.date(1990, 1, 1)), (F.col("n_nationkey") * 400).cast("int")).alias("opening_date"),
        "current_sales", "sales_target",
    )


def suppliers(t: Tables) -> DataFrame:
    s = t.supplier
    kind = F.col("s_nationkey") % 3
    stype = (F.when(kind == 0, FIXTURE_SUPPLIER_TYPES[0]).when(kind == 1, FIXTURE_SUPPLIER_TYPES[1])
              .otherwise(FIXTURE_SUPPLIER_TYPES[2]))
    return s.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        stype.alias("supplier_type"),
        F.concat(F.lit("Contact "), F.col("s_suppkey").cast("string")).alias("contact_person"),
        F.when(F.col("s_suppkey") % 7 == 0, F.lit(" "))
         .otherwise(F.concat(F.lit("orders"), F.col("s_suppkey").cast("string"), F.lit("@supplier.example")))
         .alias("email"),
        F.concat(F.lit("555"), F.lpad((F.col("s_suppkey") % 10000000).cast("string"), 7, "0")).alias("phone"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("s_suppkey").cast("string"), F.lit(" Supply Road"))).alias("address"),
        F.concat(F.lit("Net "), ((F.col("s_nationkey") % 3 + 1) * 30).cast("string")).alias("payment_terms"),
        "s_nationkey", "s_acctbal",
    )


def customers(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    seg = F.lower("c_mktsegment")
    email = (F.when(k % 4 == 0, F.concat(seg, F.lit("."), k.cast("string"), F.lit("@mail.example.com")))
              .when(k % 4 == 1, F.concat(seg, k.cast("string"), F.lit("@mailcom")))
              .when(k % 4 == 2, F.concat(F.upper(seg), F.lit("_"), k.cast("string"), F.lit("@Shop.Example.org ")))
              .otherwise(F.lit("  ")))
    area = F.lpad((k % 1000).cast("string"), 3, "0")
    line = F.lpad((k % 10000).cast("string"), 4, "0")
    phone = (F.when(k % 3 == 0, F.concat(F.lit("+1 ("), area, F.lit(") 555-"), line))
              .when(k % 3 == 1, F.concat(F.lit("("), area, F.lit(") 555-"), line))
              .otherwise(F.concat(area, F.lit("-55-"), line)))
    return c.select(
        k.alias("customer_id"),
        F.split("c_name", "#").getItem(0).alias("first_name"),
        F.when(k % 6 == 5, F.lit(None).cast("string")).otherwise(F.split("c_name", "#").getItem(1)).alias("last_name"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("-"), F.col("c_name")).alias("display_name"),
        email.alias("email"), phone.alias("phone"),
        F.date_add(F.lit(_dt.date(1940, 1, 1)), ((k * 7919) % 25000).cast("int")).alias("birth_date"),
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("account_balance_text"),
        F.col("c_nationkey").cast("bigint").alias("store_id"),
        "c_mktsegment", "c_acctbal",
    )


def campaigns(t: Tables) -> DataFrame:
    """Campaign role: the order priorities; each window starts a fixed time after the priority's first order."""
    first = t.orders.groupBy(F.col("o_orderpriority").alias("campaign_id")).agg(
        F.to_date(F.min("o_orderdate")).alias("_first"))
    fixed = t.spark.createDataFrame(
        list(FIXTURE_CAMPAIGNS),
        "campaign_id string, campaign_name string, _start int, _days int, budget string, demographics string")
    start = F.date_add("_first", F.col("_start"))
    # the fixed side has one row per entry of FIXTURE_CAMPAIGNS
    return first.join(F.broadcast(fixed), "campaign_id").select(
        "campaign_id", "campaign_name", start.alias("start_date"), F.date_add(start, F.col("_days")).alias("end_date"),
        F.col("budget").cast("decimal(18,2)").alias("budget"), "demographics")


# ---------------------------------------------------------------------------
# landing JSON role (one JSON text per order, built row by row: no grouping)
# ---------------------------------------------------------------------------

_ITEMS_JSON = (
    "case when o_orderkey % 5 = 4 then 'null' "
    "when o_orderkey % 5 = 0 then '[]' "
    "else concat('[', array_join(transform(sequence(1, cast(o_orderkey % 5 as int)), i -> "
    "concat('{\"product_id\":\"', cast((o_orderkey * 7 + i) % 1000 as string), "
    "'\",\"quantity\":\"', cast(i + o_orderkey % 3 as string), "
    "case when i = 2 then '.7' else '' end, '\"}')), ','), ']') end"
)

_PAYLOAD_JSON = (
    "concat('{\"order_id\":\"', cast(o_orderkey as string), '\",', "
    "'\"customer_id\":', cast(o_custkey as string), ',', "
    "'\"order_date\":\"', date_format(o_orderdate, 'yyyy-MM-dd'), '\",', "
    "'\"order_status\":\"', o_orderstatus, '\",', "
    "'\"total_price\":\"$', format_number(o_totalprice, 2), '\",', "
    "'\"meta\":{\"priority\":\"', o_orderpriority, '\",\"clerk_no\":', cast(o_orderkey % 100 as string), '},', "
    "'\"tags\":[\"', o_orderstatus, '\",\"', o_orderpriority, '\"],', "
    "'\"order_items\":', " + _ITEMS_JSON + ", '}')"
)

_SOURCE_FILE = (
    "case when o_orderkey % 10 = 0 then 'landing/orders_data/orders_latest.json' "
    "else concat('landing/orders_data/orders_', date_format(o_orderdate, 'yyyy-MM-dd'), '.json') end"
)

# Load metadata of the simulated landing run.
FIXTURE_RUN_ID = "run-0001"
FIXTURE_LOADED_AT = _dt.datetime(2001, 6, 30, 12, 0, 0)


def order_landing(t: Tables) -> DataFrame:
    """Orders rendered as landing records: ``(value VARIANT, raw_json, _source_file)``.

    Each order's JSON (with a nested object, an array of tags and an
    ``order_items`` array that is empty, NULL or 1-3 elements long) is built
    from its own row, so the cost is linear and there is no grouping.
    """
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.select(F.expr(_PAYLOAD_JSON).alias("raw_json"), F.expr(_SOURCE_FILE).alias("_source_file")) \
            .select(F.try_parse_json("raw_json").alias("value"), "raw_json", "_source_file")

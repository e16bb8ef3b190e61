"""Assemble the whole mart lazily from the test tables (roles -> silver -> gold).

Each property builds a DataFrame once per ``Mart``; nothing runs until an
action, so Catalyst sees every query's full plan and prunes what it does
not need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark import config
from shelfspark.operators.joins import star_lookup
from shelfspark.plans import campaign as C
from shelfspark.plans import gold as G
from shelfspark.plans import inventory as I
from shelfspark.plans import orders as O
from shelfspark.sources import tpch_roles as R


class Mart:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of=R.FIXTURE_AS_OF):
        self.spark = spark
        self.t = R.Tables(spark, sf_dir)
        self.as_of = as_of
        self.cal_start = R.FIXTURE_CALENDAR_START
        self.cal_end = R.FIXTURE_CALENDAR_END_EXCLUSIVE

    # -- roles / silver ----------------------------------------------------
    @cached_property
    def headers(self) -> DataFrame:
        return R.order_headers(self.t)

    @cached_property
    def item_versions(self) -> DataFrame:
        return R.item_versions(self.t)

    @cached_property
    def items(self) -> DataFrame:
        return R.order_items(self.t, self.headers)

    @cached_property
    def sold_items(self) -> DataFrame:
        """The items without their prices, which the inventory doesn't use."""
        return R.order_items(self.t, self.headers, priced=False)

    @cached_property
    def orders(self) -> DataFrame:
        return O.silver_orders(self.headers, self.item_versions, self.as_of)

    @cached_property
    def history(self) -> DataFrame:
        return R.product_history(self.t)

    @cached_property
    def snapshots(self) -> DataFrame:
        """The history without the product's attributes."""
        return R.product_snapshots(self.t)

    @cached_property
    def snapshot_attributes(self) -> list[I.Lookup]:
        return [(R.product_attributes(self.t), "product_id", ["reorder_level", "cost_price"])]

    @cached_property
    def stores(self) -> DataFrame:
        return R.stores(self.t)

    @cached_property
    def suppliers(self) -> DataFrame:
        return R.suppliers(self.t)

    @cached_property
    def customers(self) -> DataFrame:
        return R.customers(self.t)

    @cached_property
    def campaigns(self) -> DataFrame:
        return R.campaigns(self.t)

    @cached_property
    def inventory(self) -> DataFrame:
        return I.silver_inventory(self.snapshots, self.sold_items, attributes=self.snapshot_attributes)

    # -- gold -----------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return G.dim_date(self.spark, self.cal_start, self.cal_end, config.HOLIDAYS)

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return G.dim_marketing_campaign(self.campaigns)

    @cached_property
    def dim_products(self) -> DataFrame:
        return G.dim_products(R.product_history(self.t, newest=True), self.suppliers)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return G.dim_stores(self.stores)

    @cached_property
    def dim_suppliers(self) -> DataFrame:
        return G.dim_suppliers(self.suppliers)

    def fact_with(self, product: Sequence[str] | None = None, store: Sequence[str] | None = None,
                  supplier: Sequence[str] | None = None, cluster_by: Mapping[str, Column] | None = None,
                  supplier_rows: Sequence[str] | None = None) -> DataFrame:
        """The inventory fact, with dimension columns looked up before the fan-out.

        Equal to ``G.fact_inventory`` and star lookups on its surrogate keys: a lookup of the key by natural key and one
        of columns by that key are one lookup of a dimension joined with itself, however often a member is in it (products
        by their id, by which both sides are dealt already; key and id stand for each other).  A natural id is NULL where the dimension lacks it; ``_product_id`` keeps it.
        ``supplier_rows``: columns of the suppliers as ``_suppliers``, a list of the rows of the fact's supplier key.
        """
        suppliers = G.keyed_lookup(self.dim_suppliers, "supplier_id", "supplier_key", supplier)
        if supplier_rows:
            suppliers = G.rows_by_key(self.dim_suppliers, "supplier_id", "supplier_key", supplier_rows, "_suppliers")
        stores = G.keyed_lookup(self.dim_stores, "store_id", "store_key", store)
        products = self.dim_products.select("product_id", "product_key"), "product_id", ["product_key"]
        if product is not None:
            products = star_lookup(products[0], [(self.dim_products, "product_id", product)]), "product_id", ["product_key", *product]
        inv = I.silver_inventory(self.snapshots, self.sold_items, [suppliers, products], [stores], cluster_by, self.snapshot_attributes)
        return G.with_calendar_key(inv, self.cal_start, self.cal_end).withColumn("_product_id", F.col("product_id")).withColumns({
            f"{d}_id": F.when(F.col(f"{d}_key").isNotNull(), F.col(f"{d}_id")) for d in ("product", "store", "supplier")})

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return self.fact_with().select(*G.FACT_INVENTORY_COLUMNS)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return C.first_repeat_flags(C.sales_base(self.orders))

    @cached_property
    def campaign_days(self) -> DataFrame:
        return C.campaign_calendar(self.dim_campaign, self.dim_date)

    @cached_property
    def fact_marketing(self) -> DataFrame:
        return C.fact_marketing_performance(self.dim_campaign, self.dim_date, self.orders)

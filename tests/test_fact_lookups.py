"""Dimension columns of the inventory fact are looked up before it fans out."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.operators.dedup import latest_per_key, newest_rows
from shelfspark.operators.joins import share_of_group
from shelfspark.plans import gold as G
from shelfspark.plans import inventory as I
from shelfspark.plans import registry as Q
from shelfspark.plans import reports as RP
from shelfspark.sources import tpch_roles as R


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("mart"))
    day = lambda n: dt.datetime(1997, 1, 1) + dt.timedelta(days=n)

    def put(name, rows, spec):
        spark.createDataFrame(rows, spec).write.parquet(f"{at}/{name}.parquet")

    put("region", [(0, "R")], "r_regionkey int, r_name string")
    put("nation", [(n, f"N{n}", 0) for n in (0, 1, 2, 2)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(c, f"Customer#{c}", c % 4, 1.0, "SEG") for c in range(8)],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    # supplier 1 twice; 3 is missing
    put("supplier", [(1, "S1", 0, 1.0), (1, "S1", 0, 1.0), (2, "S2", 1, 2.0)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    put("part", [(p, f"part {p}", "B", f"T{p % 2}", 1, 10.0) for p in (0, 1, 2, 2)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("orders", [(o, o % 8, "F", 5.0, day(o), "2-HIGH") for o in range(40)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    put("lineitem", [(o, (o + i) % 4 if o != 7 else None, 1 + (o // 3) % 3, i, 2.0 + i, 100.0, 0.0, 0.0, "N", "O", day(o) if o != 9 else None)
                     for o in range(40) for i in (1, 2)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    return at


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_same_rows_as_lookups_on_the_fact(spark, tables):
    m = Q.mart(spark, tables)
    products = G.dim_products(m.history, m.suppliers)
    assert _rows(m.dim_products) == _rows(products)
    fact = G.fact_inventory(m.inventory, products, m.dim_stores, m.dim_suppliers, m.cal_start, m.cal_end)
    assert fact.count() > m.inventory.count() > 0 and _rows(m.fact_inventory) == _rows(fact)
    dims = m.dim_date, products, m.dim_stores, m.dim_suppliers
    assert _rows(Q.q_inventory_valuation(spark, tables)) == _rows(RP.inventory_valuation(fact, *dims))
    assert _rows(Q.q_turnover_category(spark, tables)) == _rows(RP.stock_turnover(fact, *dims[:3]))
    assert _rows(Q.q_supplier_category_contribution(spark, tables)) == _rows(RP.supplier_contribution(fact, dims[1], dims[3]))
    assert _rows(Q.q_ontime_vs_delayed(spark, tables)) == _rows(RP.ontime_vs_delayed(fact, dims[0], dims[2], dims[3]))


def test_no_lookup_above_the_fan_out(spark, tables):
    for name in ("inventory_valuation", "turnover_category", "check_not_null"):
        plan = _plan(Q.QUERIES[name](spark, tables))
        assert "_group_total" not in plan, name     # the day's totals are not computed where no share is asked for
    plan = _plan(Q.q_turnover_category(spark, tables))
    # the fan-out joins the list of stores; products join the snapshots below it
    fan_out = next(line for line in plan.splitlines() if "Join Inner" in line and "product_id" in line)
    products = next(line for line in plan.splitlines() if "Join LeftOuter" in line and "product_id" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    assert depth(products) > depth(fan_out)


def test_inventory_attributes_looked_up_after_the_sales(spark, tables):
    m = Q.mart(spark, tables)       # part 2 is there twice, part 3 not at all
    whole = I.silver_inventory(m.history, m.items)
    assert whole.where("inventory_value IS NULL").count() > 0 and _rows(m.inventory) == _rows(whole)
    keys = m.inventory.where("product_id = 2").select("inventory_key")
    assert keys.count() > keys.distinct().count()


def test_snapshots_are_dealt_by_product_and_date_once(spark, tables):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, chains in (("inventory_movement", 1), ("star_lookup", 2)):     # star_lookup: the rows and the days' totals
            plan = Q.QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
            dealt = re.findall(r"Exchange hashpartitioning\(product_id#\d+L, (\w+)#", plan)
            assert 1 <= dealt.count("inventory_date") <= chains, name            # the day maps, not the snapshots
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_timeliness_is_dealt_before_it_fans_out(spark, tables):
    plan = _plan(Q.q_ontime_vs_delayed(spark, tables))
    assert plan.index("Aggregate [supplier_key") < plan.index("Generate explode(_stores") < plan.index("RepartitionByExpression [supplier_key")


def test_timeliness_looks_suppliers_up_before_it_is_dealt(spark, tables):
    plan = _plan(Q.q_ontime_vs_delayed(spark, tables))
    above = plan[:plan.index("Aggregate [supplier_key")]
    assert "Join LeftOuter, (store_key" in above and "Join LeftOuter, (supplier_key" not in above


def test_lists_of_stores_are_dealt_as_text(spark, tables):
    m = Q.mart(spark, tables)
    by = {"_year": F.year("inventory_date")}
    pairs = I.product_store(m.sold_items)
    plain = I.fan_out_with_sales(m.history, pairs, I.completed_sales(m.sold_items))
    for kind in ("bigint", "string"):
        p, s = (df.withColumn("store_id", F.col("store_id").cast(kind)) for df in (pairs, I.completed_sales(m.sold_items)))
        if kind == "string":    # ids that hold the comma
            p, s = (df.withColumn("store_id", F.concat("store_id", F.lit(",a"))) for df in (p, s))
        rows = I.fan_out_with_sales(m.history, p, s, cluster_by=by).drop("_year")
        assert dict(rows.dtypes)["store_id"] == kind
        assert _rows(rows.withColumn("store_id", F.regexp_replace(F.col("store_id").cast("string"), ",a", "").cast("bigint"))) == _rows(plain)
        plan = _plan(rows)
        dealt = plan[plan.index("RepartitionByExpression"):]
        assert ("array_join" in dealt) == (kind == "bigint")


def test_newest_rows(spark):
    d = dt.date(2024, 1, 1)
    rows = [(1, d, 1), (1, d, 2), (1, dt.date(2023, 1, 1), 3), (2, None, 4), (2, d, 5), (None, d, 6), (None, None, 7), (3, d, 8)]
    df = spark.createDataFrame(rows, "k long, at date, n int")
    assert sorted(r.n for r in newest_rows(df, "k", "at").collect()) == [1, 2, 4, 7, 8]
    order = [("at", True, True), ("n", False, False)]
    assert _rows(latest_per_key(newest_rows(df, "k", "at"), ["k"], order)) == _rows(latest_per_key(df, ["k"], order))
    assert newest_rows(df.limit(0), "k", "at").count() == 0


def test_shares_of_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), (dt.date(1970, 1, 1), 4)], "d date, n int")
    for key in ("d", "t"):
        got = share_of_group(df.withColumn("t", F.col("d").cast("string")), key, "n", "share")
        assert sorted((r.n, r.share) for r in got.collect()) == [(1, 25.0), (3, 75.0), (4, 100.0)]
    joined = share_of_group(df, "d", "n", "share").select("n")
    assert "Join" not in _plan(joined)


def test_sold_items_are_the_items_without_prices(spark):
    day = dt.datetime(1997, 1, 1)
    # repeated versions of an item that tie in the date, in all kept columns, and in nothing; NULLs among them
    versions = [(1, 1, p, s, q, x, d, f, at) for p in (5, 6, None) for s in (1, None) for q in (2.0, 3.0) for x, d, f in ((10.0, 0.1, "N"), (9.0, None, "R"))
                for at in (day, day + dt.timedelta(days=1))]
    versions += [(2, 1, 5, 1, 2.0, x, 0.0, "N", None if x == 1.0 else day) for x in (1.0, 2.0, 3.0)] + [(None, 1, 5, 1, 2.0, 1.0, 0.0, "N", day)]
    lineitem = spark.createDataFrame(
        versions, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
        "l_discount double, l_returnflag string, l_shipdate timestamp").selectExpr("*", "l_discount AS l_tax", "l_returnflag AS l_linestatus")
    headers = spark.createDataFrame([(1, day.date(), "Delivered", 3, 4)], "order_id bigint, order_date date, order_status string, customer_id bigint, store_id bigint")
    tables = R.Tables(spark, "")
    tables.lineitem = lineitem
    sold = R.order_items(tables, headers, priced=False)
    whole = R.order_items(tables, headers)
    assert set(whole.columns) - set(sold.columns) == {"unit_price", "cost_price", "item_discount_rate"}
    assert whole.count() == 3 and _rows(sold) == _rows(whole.select(*sold.columns))


def test_the_inventory_reads_no_prices(spark, tables):
    for name in ("inventory_movement", "star_lookup", "ontime_vs_delayed"):
        scans = Q.QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
        assert "l_quantity" in scans and "l_extendedprice" not in scans, name

"""Landing JSON -> bronze -> silver on a generated landing folder with the edge cases of FIXTURES.md."""

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfspark.operators.incremental import new_rows
from shelfspark.plans import silver as SV
from shelfspark.sources.freshness import freshness
from shelfspark.sources.landing import discover_landing, read_landing, to_bronze

AS_OF = dt.date(2024, 7, 1)
LOADED = dt.datetime(2024, 7, 1, 8, 0, 0)


def _write(root, folder, name, records, layout):
    os.makedirs(os.path.join(root, folder), exist_ok=True)
    with open(os.path.join(root, folder, name), "w") as fh:
        if layout == "array":
            json.dump(records, fh)
        else:
            fh.write("\n".join(json.dumps(r) for r in records) + "\n")


@pytest.fixture(scope="module")
def landing():
    root = tempfile.mkdtemp(prefix="landing-")
    order_a = {"order_id": "O1", "customer_id": "C1", "store_id": "S1", "campaign_id": "K1",
               "order_date": "2024-06-01T22:30:00-05:00", "shipping_date": "2024-06-02",
               "delivery_date": "2024-06-05", "estimated_delivery_date": "2024-06-06",
               "discount_amount": "10", "shipping_cost": "$1,234.56", "tax_amount": "abc",
               "order_status": "delivered", "payment_method": "credit-card",
               "order_items": [{"product_id": "P1", "quantity": "3.7", "unit_price": "$10.00",
                                "cost_price": "6", "discount_amount": "5"},
                               {"product_id": " ", "quantity": "1", "unit_price": "2", "cost_price": "1"}]}
    order_b = dict(order_a, order_status="completed")
    _write(root, "orders_data", "orders_2024-06-01.json", [order_a,
           {"order_id": "O2", "order_items": [], "order_date": "2024-06-01"},
           {"order_id": "O3", "order_date": "2024-06-01"},
           {"order_id": "  ", "order_date": "2024-06-01"}], "lines")
    _write(root, "orders_data", "orders_2024-06-03.json", [order_b], "array")
    _write(root, "orders_data", "orders_latest.json", [{"order_id": "O4", "order_items": None}], "lines")
    _write(root, "customer-data", "customers_2024-06-01.json", [
        {"customer_id": "C1", "first_name": "mary-jane", "last_name": "o'neil3", "email": "A@B.COM",
         "phone": "(555) 123-4567", "birth_date": "2000-02-29", "marketing_opt_in": "ON",
         "total_spend": "$1,234.56", "total_purchases": "3.7",
         "address": {"street": "1 main st", "city": "austin", "state": "tx", "zip_code": "78701", "country": "us"}},
        {"customer_id": "C2", "first_name": "bob", "email": "a@bcom", "phone": "555-1234",
         "birth_date": "04/01/1990"},
        {"customer_id": "", "first_name": "ghost"}], "lines")
    _write(root, "store_data", "stores_2024-06-01.json", [
        {"store_id": "S1", "store_name": "main street", "size_sq_ft": "4500", "employee_count": "10",
         "opening_date": "2010-06-15", "sales_target": "$100,000", "current_sales": "$85,000"}], "lines")
    _write(root, "supplier_data", "suppliers_2024-06-13.json", [
        {"supplier_id": "SP1", "supplier_name": "acme co", "is_active": "true",
         "contact_information": {"email": "x@y.org", "phone": "555 123 45678"},
         "performance_metrics": {"defect_rate": "1.234"}}], "lines")
    _write(root, "product_data", "products_2024-06-01.json", [
        {"product_id": "P1", "name": "super widget", "unit_price": "$10.00", "cost_price": "$6.00",
         "stock_quantity": "5", "reorder_level": "8", "weight": "1.5 kg", "is_featured": "false"}], "lines")
    _write(root, "product_data", "products_2024-06-03.json", [
        {"product_id": "P1", "name": "super widget", "unit_price": "$11.00", "cost_price": "$6.00",
         "stock_quantity": "9", "reorder_level": "8", "is_featured": "true"}], "lines")
    _write(root, "campaign_data", "campaigns_2024-06-01.json", [
        {"campaign_id": "K1", "campaign_name": "Summer", "start_date": "2024-06-01", "end_date": "2024-05-01",
         "budget": "$5,000", "demographics": {"age": "18-35"}}], "lines")
    _write(root, "employee_data", "employees_2024-06-01.json", [
        {"employee_id": "E1", "first_name": "ann", "phone": "+1 555 123 4567", "salary": "abc"}], "lines")
    return root


def _bronze(spark, root, folder, key, layout="lines"):
    return to_bronze(read_landing(spark, root, folder, layout), f"$.{key}", key, "run-1", LOADED)


def test_discover_landing(spark, landing):
    found = {r.folder: r.table_name for r in discover_landing(spark, landing).collect()}
    assert found["customer-data"] == "EXT_CUSTOMER_DATA"
    assert found["orders_data"] == "EXT_ORDERS_DATA"


def test_json_suffix_in_any_case(spark, tmp_path):
    _write(str(tmp_path), "stores_data", "stores_2024-06-01.JSON", [{"store_id": "S1"}], "lines")
    _write(str(tmp_path), "notes", "notes.txt", [{"x": 1}], "lines")
    assert [r.folder for r in discover_landing(spark, str(tmp_path)).collect()] == ["stores_data"]
    assert read_landing(spark, str(tmp_path), "stores_data").count() == 1


def test_layouts_keep_every_record(spark, landing):
    lines = read_landing(spark, landing, "orders_data", "lines")
    # H8: every line of the line-delimited files is one record
    assert lines.filter(~F.col("_source_file").endswith("06-03.json")).count() == 5
    arr = read_landing(spark, landing, "orders_data", "array").filter(F.col("_source_file").endswith("06-03.json"))
    # the array file gives one record per element, parsed as an object
    assert arr.count() == 1 and arr.first().raw_json.startswith("{")


def test_layout_of_each_file(spark, tmp_path):
    folder = tmp_path / "stores_data"
    folder.mkdir()

    def put(name, text, encoding="utf-8"):
        (folder / name).write_text(text, encoding=encoding)

    one, two = json.dumps({"store_id": "S1", "tags": [1, 2]}), json.dumps({"store_id": "S2"})
    put("lines.json", f"\n  \n{one}\n\n{two}\n")
    put("array.json", f"\n \t\n [\n{one},\n{two}]")
    put("array [1] of {2}.json", f"[{two}]")
    put("bom lines.json", f"{one}\n", "utf-8-sig")
    put("bom array.JSON", f"[{one}]", "utf-8-sig")
    put("empty.json", "")
    put("blank.json", " \n\n")
    put("none.json", "[]")
    got = read_landing(spark, str(tmp_path), "stores_data", "auto")
    ids = F.try_variant_get("value", "$.store_id", "string")
    found = sorted((r.f.rsplit("/", 1)[1], r.i) for r in got.select(F.url_decode("_source_file").alias("f"), ids.alias("i")).collect())
    assert found == [("array [1] of {2}.json", "S2"), ("array.json", "S1"), ("array.json", "S2"), ("bom array.JSON", "S1"),
                     ("bom lines.json", "S1"), ("lines.json", "S1"), ("lines.json", "S2")]
    (folder / "lines.json").unlink()
    only_lines = tmp_path / "more"
    only_lines.mkdir()
    (only_lines / "a.json").write_text(one)
    assert read_landing(spark, str(tmp_path), "more", "auto").count() == 1
    with pytest.raises(ValueError):
        read_landing(spark, str(tmp_path), "more", "other")


def test_bronze_and_incremental(spark, landing):
    b = _bronze(spark, landing, "orders_data", "order_id")
    assert set(b.columns) == {"order_id", "raw_payload", "_source_file", "_loaded_at", "_batch_id"}
    again = new_rows(b, b, ["order_id", "_source_file"])
    assert again.filter(F.col("order_id").isNotNull()).count() == 0


def test_silver_orders_and_items(spark, landing):
    b = _bronze(spark, landing, "orders_data", "order_id").filter(~F.col("_source_file").endswith("06-03.json"))
    arr = to_bronze(read_landing(spark, landing, "orders_data", "array")
                    .filter(F.col("_source_file").endswith("06-03.json")), "$.order_id", "order_id", "run-1", LOADED)
    bronze = b.unionByName(arr)
    orders = {r.order_id: r for r in SV.silver_orders(bronze, AS_OF).collect()}
    # the raw bronze key is kept (only NULL keys are dropped), newest version per order
    assert set(orders) == {"O1", "O2", "O3", "O4", "  "}
    o1 = orders["O1"]
    assert o1.order_status == "Completed"                   # from the later file
    assert o1.source_snapshot_date == dt.date(2024, 6, 3)
    assert o1.order_hour == 22 and o1.order_time_of_day == "Night"   # wall clock, not UTC (H7)
    assert o1.order_discount_rate == Decimal("0.100000")
    assert o1.shipping_cost == Decimal("1234.56") and o1.tax_amount == Decimal("0.00")
    assert o1.total_quantity == 10                          # (4 + 1) summed over both versions (H11)
    assert o1.total_items == 2                              # blank product ids are not counted
    assert o1.delivery_status == "On Time" and o1.processing_days == 1
    assert orders["O4"].source_snapshot_date is None and orders["O4"].total_items == 0
    items = SV.silver_order_items(bronze).collect()
    assert sorted((r.order_id, r.item_number, r.quantity) for r in items) == [("O1", 1, 4), ("O1", 2, 1)]


def test_silver_customers(spark, landing):
    c = {r.customer_id: r for r in SV.silver_customers(_bronze(spark, landing, "customer-data", "customer_id"),
                                                        AS_OF).collect()}
    assert set(c) == {"C1", "C2"}
    c1, c2 = c["C1"], c["C2"]
    assert c1.first_name == "Mary-Jane" and c1.last_name == "O'neil" and c1.full_name == "Mary-Jane O'neil"
    assert c1.email_id == "a@b.com" and c1.phn_no == "5551234567" and c1.phn_no_valid
    assert c1.customer_age == 24 and c1.customer_segment == "Young"
    assert c1.marketing_opt_in is True and c1.total_spend == Decimal("1234.56") and c1.total_purchases == 4
    assert c1.standardized_address == "1 Main St, Austin, TX, 78701, Us"
    assert c2.email_id is None and not c2.email_valid and c2.phn_no is None
    assert c2.birth_date == dt.date(1990, 4, 1) and c2.standardized_address is None


def test_silver_stores_suppliers_products_campaigns_employees(spark, landing):
    s = SV.silver_stores(_bronze(spark, landing, "store_data", "store_id"), AS_OF).first()
    assert s.store_size_category == "Small" and s.store_age_years == 14
    assert s.sales_target_achievement_percentage == Decimal("85.00") and s.performance_issue_flag
    sp = SV.silver_suppliers(_bronze(spark, landing, "supplier_data", "supplier_id")).first()
    assert sp.supplier_name == "Acme Co" and sp.is_active is True and sp.phone == "55512345678"
    assert sp.defect_rate == Decimal("1.23")
    hist = SV.silver_product_history(_bronze(spark, landing, "product_data", "product_id")).collect()
    assert sorted((r.source_snapshot_date, r.stock_quantity) for r in hist) == \
        [(dt.date(2024, 6, 1), 5), (dt.date(2024, 6, 3), 9)]
    p = SV.silver_products(_bronze(spark, landing, "product_data", "product_id")).first()
    assert p.unit_price == Decimal("11.00") and p.low_stock_flag is False and p.product_name == "Super Widget"
    assert hist[0].product_name in ("SuperWidget",)
    k = SV.silver_campaigns(_bronze(spark, landing, "campaign_data", "campaign_id")).first()
    assert k.campaign_duration_days is None and k.budget == Decimal("5000.00")
    assert json.loads(k.demographics) == {"age": "18-35"}
    e = SV.silver_employees(_bronze(spark, landing, "employee_data", "employee_id")).first()
    assert e.full_name is None and e.phone == "15551234567" and e.salary == Decimal("0.00")


def test_freshness(spark, landing):
    b = _bronze(spark, landing, "orders_data", "order_id")
    ts = F.to_timestamp(F.get_json_object("raw_payload", "$.order_date").substr(1, 10))
    # the array-layout file read as lines has no top-level order_date: newest is 1 June
    row = freshness(b, ts, "orders", dt.datetime(2024, 6, 4, 12, 0)).first()
    assert row.status == "error" and row.max_loaded_at == dt.datetime(2024, 6, 1) and row.age_hours == 84.0
    assert freshness(b, ts, "orders", dt.datetime(2024, 6, 2, 12, 0)).first().status == "warn"
    assert freshness(b, ts, "orders", dt.datetime(2024, 6, 1, 12, 0)).first().status == "pass"


def test_streaming_ingest_is_incremental(spark, landing):
    from shelfspark.streaming.landing_stream import start_bronze_ingest

    work = tempfile.mkdtemp(prefix="stream-")
    target, ckpt = os.path.join(work, "bronze"), os.path.join(work, "ckpt")
    q = start_bronze_ingest(spark, landing, "customer-data", "$.customer_id", "customer_id", target, ckpt, "run")
    q.awaitTermination(120)
    first = spark.read.parquet(target).count()
    assert first == 3
    _write(landing, "customer-data", "customers_2024-06-02.json", [{"customer_id": "C9"}], "lines")
    q = start_bronze_ingest(spark, landing, "customer-data", "$.customer_id", "customer_id", target, ckpt, "run")
    q.awaitTermination(120)
    assert spark.read.parquet(target).count() == first + 1


def test_pipeline_run_and_increment(spark, landing):
    from shelfspark.plans.pipeline import run_pipeline

    wh = tempfile.mkdtemp(prefix="warehouse-")
    folders = {"customers": "customer-data"}
    r1 = run_pipeline(spark, landing, wh, "run-1", AS_OF, folders=folders)
    assert "fact_inventory" in r1.tables and "rpt_inventory_valuation" in r1.views
    assert spark.table("rpt_inventory_valuation").count() == 2          # P1 x store S1 x two snapshot days
    row = spark.table("rpt_inventory_valuation").orderBy("full_date").first()
    assert row.product_id == "P1" and row.store_id == "S1" and row.full_date == dt.date(2024, 6, 1)
    assert spark.table("rpt_customer_engagement_metrics").count() == 0  # the campaign ends before it starts
    n_products = r1.read(spark, "bronze_products").count()

    _write(landing, "product_data", "products_2024-06-05.json", [
        {"product_id": "P1", "name": "super widget", "unit_price": "$11.00", "cost_price": "$6.00",
         "stock_quantity": "7", "reorder_level": "8"}], "lines")
    r2 = run_pipeline(spark, landing, wh, "run-2", AS_OF, previous=r1, folders=folders)
    assert r2.read(spark, "bronze_products").count() == n_products + 1
    hist = r2.read(spark, "silver_product_history")
    assert sorted(r.source_snapshot_date.day for r in hist.collect()) == [1, 3, 5]
    assert r1.tables["fact_inventory"] != r2.tables["fact_inventory"]   # new version, old one untouched
    assert spark.read.parquet(r1.tables["fact_inventory"]).count() == 2
    assert spark.read.parquet(r2.tables["fact_inventory"]).count() == 3
    # product snapshots: one open version per (product, file date); the new file adds one, nothing is closed twice
    s1 = spark.read.parquet(r1.tables["snp_products"])
    s2 = spark.read.parquet(r2.tables["snp_products"])
    assert s1.filter("is_current").count() == 2 and s2.filter("is_current").count() == 3
    # the supplier feed's day pattern does not match day 13: the undated delivery still opens one version
    assert spark.read.parquet(r1.tables["snp_suppliers"]).count() == 1
    c2 = spark.read.parquet(r2.tables["snp_customers"])
    assert c2.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("n")).filter("n > 1").count() == 0


def test_pipeline_checks_and_freshness(spark, landing):
    from shelfspark.operators.declared import DeclaredCheckError
    from shelfspark.plans.pipeline import run_pipeline

    folders = {"customers": "customer-data"}
    run = run_pipeline(spark, landing, tempfile.mkdtemp(prefix="warehouse-"), "run-1", AS_OF, folders=folders,
                       checked_at=dt.datetime(2024, 6, 2, 0, 0))
    assert run.read(spark, "declared_checks").count() == 66
    fresh = {r.source: r.status for r in run.read(spark, "source_freshness").collect()}
    assert len(fresh) == 7 and fresh["orders"] == "pass" and fresh["campaigns"] == "pass" and fresh["stores"] == "error"

    root = tempfile.mkdtemp(prefix="landing-")
    _write(root, "orders_data", "orders_2024-06-01.json", [
        {"order_id": "O1", "order_date": "2024-06-01", "order_items": [{"product_id": None, "quantity": "1"}]}], "lines")
    with pytest.raises(DeclaredCheckError, match="silver_order_items.product_id"):
        run_pipeline(spark, root, tempfile.mkdtemp(prefix="warehouse-"), "run-1", AS_OF, checks="enforce")
    kept = run_pipeline(spark, root, tempfile.mkdtemp(prefix="warehouse-"), "run-1", AS_OF)
    assert kept.warnings == ["not_null(silver_order_items.product_id): 1"]
    assert kept.read(spark, "declared_checks").where("status = 'fail'").count() == 1

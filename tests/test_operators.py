"""Operators: dedup, windows, joins, incremental loads, SCD2, checks (invariants of SURVEY section 5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import checks as CH
from shelfspark.operators.dedup import distinct_pairs, latest_per_key
from shelfspark.operators.history import scd2_apply, scd2_build
from shelfspark.operators.incremental import after_high_watermark, merge_upsert, new_rows
from shelfspark.operators.joins import (checked_broadcast, flatten_items, range_to_calendar,
                                         share_of_group, star_lookup, with_group_total, with_total)
from shelfspark.operators.windows import global_ntile, with_previous

D = dt.date


def test_latest_per_key_nulls_and_uniqueness(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, D(2024, 1, 2), "b"), (1, D(2024, 1, 1), "c"), (2, None, "d")],
        "k int, d date, v string")
    last = latest_per_key(df, ["k"], [("d", True, False), ("v", True, False)])
    assert sorted((r.k, r.v) for r in last.collect()) == [(1, "b"), (2, "d")]
    # H1: the warehouse default puts NULLs first when descending
    first = latest_per_key(df, ["k"], [("d", True, None)])
    assert sorted((r.k, r.v) for r in first.collect()) == [(1, "a"), (2, "d")]
    assert last.groupBy("k").count().filter("count > 1").count() == 0


def test_distinct_pairs_drops_null_parts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 3)], "p int, s int")
    assert sorted(tuple(r) for r in distinct_pairs(df, ["p", "s"]).collect()) == [(1, 1), (2, 3)]


def test_with_previous_lags(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 3), 5), (1, D(2024, 1, 1), 7), (2, D(2024, 1, 1), 9)],
                               "p int, d date, s int")
    out = with_previous(df, ["p"], [("d", False, False)], {"s": "prev_s", "d": "prev_d"})
    rows = {(r.p, r.d): (r.prev_s, r.prev_d) for r in out.collect()}
    assert rows[(1, D(2024, 1, 3))] == (7, D(2024, 1, 1))
    assert rows[(1, D(2024, 1, 1))] == (None, None)


@pytest.mark.parametrize("n_rows", [0, 1, 3, 7, 8, 13])
def test_global_ntile_matches_ntile(spark, n_rows):
    rows = [(i, float((i * 7) % 5) if i % 4 else None) for i in range(n_rows)]
    df = spark.createDataFrame(rows, "k int, v double")
    ours = global_ntile(df, 4, [("v", False, False), ("k", False, False)], "q", num_partitions=3)
    from pyspark.sql import Window
    ref = df.withColumn("q", F.ntile(4).over(Window.orderBy(F.col("v").asc_nulls_last(), "k")))
    assert sorted(tuple(r) for r in ours.select("k", "q").collect()) == \
        sorted(tuple(r) for r in ref.select("k", "q").collect())


def test_share_of_group_equals_window_sum(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 3), (D(2024, 1, 1), 1), (D(2024, 1, 2), -2), (D(2024, 1, 2), 1),
                                (D(2024, 1, 3), None), (None, 6), (None, 2)], "d date, q int")
    out = {(r.d, r.q): r.pct for r in share_of_group(df, "d", "q", "pct").collect()}
    assert out[(D(2024, 1, 1), 3)] == 75.0
    assert out[(D(2024, 1, 2), -2)] == 0.0         # total <= 0 -> 0
    assert out[(D(2024, 1, 3), None)] == 0.0       # NULL total -> 0
    assert out[(None, 6)] == 75.0                  # a NULL date is a group of its own


def test_group_total_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "g string, m int")
    out = {r.g: r.t for r in with_group_total(df, "g", "m", "t").collect()}
    assert out["a"] == 3 and out[None] is None      # NULL group joins nothing (J10)
    assert with_total(df, "m", "t").first()["t"] == 8


def test_checked_broadcast(spark):
    small = spark.range(10)
    def plan(side):
        return spark.range(100).join(side, "id")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "broadcast" in plan(checked_broadcast(small, 10, known_max_rows=10))
    # without a bound by construction nothing is hinted, and nothing is counted
    assert "broadcast" not in plan(checked_broadcast(small, 10))
    assert "broadcast" not in plan(checked_broadcast(small, 10, known_max_rows=11))


def test_star_lookup_left_semantics(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20)], "k int, m int")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    out = {r.k: r.name for r in star_lookup(fact, [(dim, "k", ["name"])]).collect()}
    assert out == {1: "one", 2: None}


def test_range_to_calendar(spark):
    ranges = spark.createDataFrame([(1, D(2024, 1, 30), D(2024, 2, 2)), (2, D(2024, 2, 5), D(2024, 2, 1))],
                                   "c int, s date, e date")
    cal = spark.createDataFrame([(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(40)], "full_date date")
    # the calendar ends on 9 Feb
    out = range_to_calendar(ranges, cal, "s", "e")
    assert out.filter("c = 1").count() == 4       # 30, 31 Jan, 1, 2 Feb
    assert out.filter("c = 2").count() == 0       # end before start
    open_ended = spark.createDataFrame([(3, D(1, 1, 1), D(9999, 12, 31)), (4, None, D(2024, 2, 1)), (5, D(2024, 2, 1), None)],
                                       "c int, s date, e date")
    assert {r.c: r["count"] for r in range_to_calendar(open_ended, cal, "s", "e").groupBy("c").count().collect()} == {3: 40}
    assert range_to_calendar(open_ended, cal.limit(0), "s", "e").count() == 0


def test_sales_without_customer_are_neither_first_nor_repeat(spark):
    from shelfspark.plans.campaign import first_repeat_flags

    rows = [(i, None if i % 3 == 0 else f"c{i % 7}", D(2024, 1, 1 + i % 20)) for i in range(300)]
    sales = spark.createDataFrame(rows, "order_id int, customer_id string, order_date date")
    first = {}
    for _, c, d in rows:
        first[c] = min(d, first.get(c, d))
    got = first_repeat_flags(sales)
    assert got.columns[:3] == ["customer_id", "order_id", "order_date"]
    assert {(r.order_id, r.is_first_purchase, r.is_repeat_purchase) for r in got.collect()} == {
        (i, c is not None and d == first[c], c is not None and d > first[c]) for i, c, d in rows}
    assert got.count() == 300


def test_flatten_items_non_outer(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "o int, items array<string>")
    out = sorted(tuple(r) for r in flatten_items(df, "items").collect())
    assert out == [(1, "a", 1), (1, "b", 2)]


def test_incremental_append_and_null_keys(spark):
    src = spark.createDataFrame([(1, "f1"), (2, "f1"), (None, "f1")], "k int, f string")
    tgt = spark.createDataFrame([(1, "f1"), (None, "f1")], "k int, f string")
    out = sorted((r.k is None, r.k) for r in new_rows(src, tgt, ["k", "f"]).collect())
    assert out == [(False, 2), (True, None)]      # NULL keys never match: re-inserted
    # a second run over the appended target adds nothing but the NULL key again
    appended = tgt.unionByName(new_rows(src, tgt, ["k", "f"]))
    assert new_rows(src, appended, ["k", "f"]).filter("k is not null").count() == 0


def test_merge_upsert(spark):
    tgt = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    inc = spark.createDataFrame([(2, "new", 1), (3, "new", 1)], "k int, v string, extra int")
    out = {r.k: (r.v, r.extra) for r in merge_upsert(tgt, inc, ["k"]).collect()}
    assert out == {1: ("old", None), 2: ("new", 1), 3: ("new", 1)}


def test_high_watermark(spark):
    src = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 5),), (None,)], "d date")
    tgt = spark.createDataFrame([(D(2024, 1, 3),)], "d date")
    assert [r.d for r in after_high_watermark(src, tgt, "d").collect()] == [D(2024, 1, 5)]
    empty = spark.createDataFrame([], "d date")
    assert after_high_watermark(src, empty, "d").count() == 2   # default 1900-01-01, NULL dates skipped


def test_scd2_build_intervals_do_not_overlap(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "a"), (1, D(2024, 1, 5), "b"), (1, D(2024, 1, 5), "c"),
                                (2, D(2024, 1, 2), "x")], "k int, u date, v string")
    h = scd2_build(df, "k", "u", [("v", True, False)])
    rows = sorted((r.k, r.valid_from, r.valid_to, r.v, r.is_current) for r in h.collect())
    assert rows == [(1, D(2024, 1, 1), D(2024, 1, 5), "a", False), (1, D(2024, 1, 5), None, "c", True),
                    (2, D(2024, 1, 2), None, "x", True)]


def test_scd2_apply_is_idempotent(spark):
    first = spark.createDataFrame([(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 1), "x")], "k int, u date, v string")
    h1 = scd2_apply(None, first, "k", "u")
    second = spark.createDataFrame([(1, D(2024, 1, 4), "b"), (2, D(2024, 1, 1), "x"), (3, D(2024, 1, 4), "n")],
                                   "k int, u date, v string")
    h2 = scd2_apply(h1, second, "k", "u")
    rows = sorted((r.k, r.valid_from, r.valid_to, r.is_current) for r in h2.collect())
    assert rows == [(1, D(2024, 1, 1), D(2024, 1, 4), False), (1, D(2024, 1, 4), None, True),
                    (2, D(2024, 1, 1), None, True), (3, D(2024, 1, 4), None, True)]
    h3 = scd2_apply(h2, second, "k", "u")
    assert h3.count() == h2.count()               # re-running adds nothing


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "k int, v string")
    nn = {r.column_name: r.violations for r in CH.check_not_null(df, ["k", "v"], "t").collect()}
    assert nn == {"k": 1, "v": 1}
    assert CH.check_unique(df, "k", "t").first().violations == 1
    parent = spark.createDataFrame([(1,)], "k int")
    assert CH.check_relationships(df, "k", parent, "k", "t").first().violations == 1


def test_sinks_versioned_and_view(spark, tmp_path):
    from shelfspark.sources.sinks import cut_lineage, register_view, write_table, write_versioned

    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    base = str(tmp_path / "t")
    p1 = write_versioned(df, base)
    p2 = write_versioned(df.filter("k = 1"), base)
    assert p1 != p2 and spark.read.parquet(p1).count() == 2 and spark.read.parquet(p2).count() == 1
    write_table(df, str(tmp_path / "part"), partition_by=["k"])
    assert spark.read.parquet(str(tmp_path / "part")).filter("k = 2").count() == 1
    register_view(df, "sink_view_test")
    assert spark.sql("select count(*) c from sink_view_test").first().c == 2
    assert cut_lineage(df).count() == 2


def test_strict_parsers_raise(spark):
    from shelfspark.functions import clean as S

    df = spark.createDataFrame([("junk",)], "x string")
    with pytest.raises(Exception):
        df.select(S.parse_bool("x", strict=True)).collect()
    with pytest.raises(Exception):
        df.select(S.parse_date("x", strict=True)).collect()
    ok = spark.createDataFrame([("yes",), ("",)], "x string").select(S.parse_bool("x", strict=True).alias("b"))
    assert [r.b for r in ok.collect()] == [True, None]


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows: results equal the literal window forms."""
    from pyspark.sql import Window

    n = 30000
    rows = [(0 if i % 3 == 0 else i, i % 17, D(2024, 1, 1) + dt.timedelta(days=i % 40), i % 11 - 3) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, v int, d date, q int").repartition(6)
    got = latest_per_key(df, ["k"], [("d", True, False), ("v", True, False), ("q", True, False)])
    w = Window.partitionBy("k").orderBy(F.col("d").desc(), F.col("v").desc(), F.col("q").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    shares = share_of_group(df, "d", "q", "pct")
    tot = F.sum("q").over(Window.partitionBy("d"))
    ref2 = df.withColumn("pct", F.when(tot > 0, F.round(F.col("q") / tot * 100.0, 6)).otherwise(F.lit(0.0)))
    assert shares.select(*ref2.columns).exceptAll(ref2).count() == 0 and ref2.exceptAll(shares.select(*ref2.columns)).count() == 0
    # the hot key stays a single group of the dedup, never a single task of the whole input
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SinglePartition" not in plan


def test_fan_out_with_sales_equals_join_form(spark):
    from shelfspark.plans import inventory as I

    hist = spark.createDataFrame(
        [(1, D(2024, 1, 1), 5, 3, 9, None), (1, D(2024, 1, 2), 4, 3, 9, None), (2, D(2024, 1, 1), 1, 3, 8, None)],
        "product_id int, source_snapshot_date date, stock_quantity bigint, reorder_level bigint, supplier_id int, "
        "cost_price decimal(18,2)")
    pairs = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "product_id int, store_id int")
    sales = spark.createDataFrame([(1, 10, D(2024, 1, 2), 2), (2, 10, D(2024, 1, 1), 1)],
                                  "product_id int, store_id int, inventory_date date, sold_quantity bigint")
    fast = I.fan_out_with_sales(hist, pairs, sales)
    slow = I.with_sales(I.fan_out(I.stock_snapshots(hist), pairs), sales)
    cols = ["product_id", "store_id", "inventory_date", "beginning_stock", "ending_stock", "sold_quantity",
            "previous_inventory_date"]
    assert sorted(tuple(r) for r in fast.select(*cols).collect()) == sorted(tuple(r) for r in slow.select(*cols).collect())

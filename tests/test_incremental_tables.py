"""Partitioned tables, the log of loaded files and the lazy NTILE."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfspark.operators.incremental import merge_upsert, new_rows
from shelfspark.operators.load_log import KEYS_PER_BLOCK, LOG_SCHEMA, log_entries, new_rows_logged, probed
from shelfspark.operators.windows import global_ntile, with_previous, with_previous_segmented
from shelfspark.sources.partitioned import PartitionedTable, key_bucket

ROWS = "k string, d date, v int"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def bag(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_second_run_writes_in_proportion_to_its_delivery(spark, tmp_path):
    base = str(tmp_path / "t")
    first = spark.createDataFrame([(f"{i % 40}", day(i // 40), i) for i in range(40 * 50)], ROWS)
    one = PartitionedTable(spark, base).merge(first, ["k", "d"], F.col("d"))
    before = files(base)
    assert len(one.parts) == 50
    delivery = spark.createDataFrame([("1", day(49), -1), ("new", day(49), -2), ("1", day(50), -3), (None, day(49), -4)], ROWS)
    two = one.merge(delivery, ["k", "d"], F.col("d"))
    after = files(base)
    assert before.items() <= after.items()  # nothing is touched
    added = sum(after.values()) - sum(before.values())
    assert added < sum(before.values()) / 10
    assert bag(two.read()) == bag(merge_upsert(first, delivery, ["k", "d"]))
    assert bag(one.read()) == bag(first)  # the older version stays
    assert bag(PartitionedTable.open(spark, two.manifest).read([str(day(49))])) == bag(two.read().where(F.col("d") == day(49)))
    # another run on the older version, as after a failed one
    again = one.merge(delivery, ["k", "d"], F.col("d"))
    assert bag(again.read()) == bag(two.read())


def test_buckets_null_keys_and_empty_deliveries(spark, tmp_path):
    part = key_bucket(["k"], 4)
    rows = spark.createDataFrame([(f"{i}", None, i) for i in range(30)] + [(None, None, 100)], ROWS)
    t = PartitionedTable(spark, str(tmp_path / "t")).merge(rows, ["k"], part)
    assert len(t.parts) <= 4
    more = spark.createDataFrame([("3", day(1), 5), ("3", day(2), 6), (None, None, 101)], ROWS)
    u = t.merge(more, ["k"], part)
    assert bag(u.read()) == bag(merge_upsert(rows, more, ["k"]))
    none = spark.createDataFrame([], ROWS)
    assert bag(u.merge(none, ["k"], part).read()) == bag(u.read())
    empty = PartitionedTable(spark, str(tmp_path / "e")).merge(none, ["k"], part)
    assert empty.read().count() == 0 and empty.read().columns == ["k", "d", "v"]
    assert bag(empty.merge(more, ["k"], part).read()) == bag(more)
    odd = spark.createDataFrame([("a/b=c", None, 1), ("a b", None, 2), ("", None, 3)], ROWS)
    assert bag(PartitionedTable(spark, str(tmp_path / "o")).append(odd, F.col("k")).read()) == bag(odd)


def test_schema_grows_with_the_runs(spark, tmp_path):
    one = PartitionedTable(spark, str(tmp_path / "t")).append(spark.createDataFrame([("a", 1, 1.5)], "k string, n int, x float"), F.lit("p"))
    two = one.append(spark.createDataFrame([(1 << 40, "b", "new", 2.5)], "n long, k string, extra string, x double"), F.lit("p"))
    assert bag(two.read()) == sorted([repr(("a", 1, 1.5, None)), repr(("b", 1 << 40, 2.5, "new"))])
    three = two.append(spark.createDataFrame([("c",)], "k string"), F.lit("q"))
    assert [(r.k, r.n, r.extra) for r in three.read().orderBy("k").collect()] == [("a", 1, None), ("b", 1 << 40, "new"), ("c", None, None)]
    merged = three.merge(spark.createDataFrame([("a", 7, True)], "k string, n int, flag boolean"), ["k"], F.lit("p"))
    assert merged.read().where("k = 'a'").first().asDict() == {"k": "a", "n": 7, "x": None, "extra": None, "flag": True}
    assert merged.read().count() == 3
    with pytest.raises(ValueError):
        three.append(spark.createDataFrame([("c", "text")], "k string, n string"), F.lit("q"))


KEYS = ["k", "f"]


def delivered(spark, rows):
    return spark.createDataFrame(rows, "k string, f string, v int")


def test_new_files_read_no_old_row(spark):
    held = delivered(spark, [(f"{i}", f"file{i % 3}", i) for i in range(300)])
    log = log_entries(held, KEYS, "f", "load1")

    def never(loads):
        raise AssertionError("the target was read")

    new = delivered(spark, [(f"{i}", "file9", i) for i in range(50)] + [(None, "file0", 1), ("5", None, 2)])
    assert bag(new_rows_logged(new, log, never, KEYS, "f")) == bag(new)
    assert bag(new_rows_logged(new, None, never, KEYS, "f")) == bag(new)


def test_logged_anti_join_is_exact(spark):
    rnd = random.Random(1)
    held = [(f"{rnd.randint(0, 5000)}", f"file{rnd.randint(0, 5)}", i) for i in range(3000)] + [(None, "file1", 0), (None, "nulls", 0)]
    # a third of all keys in one file: several blocks
    held += [(f"big{i}", "big", i) for i in range(3 * KEYS_PER_BLOCK)]
    target = {"a": delivered(spark, held[:2000]), "b": delivered(spark, held[2000:])}
    log = log_entries(target["a"], KEYS, "f", "a").unionByName(log_entries(target["b"], KEYS, "f", "b"))
    assert log.where("file = 'big'").count() == 3 and log.where("file = 'nulls'").count() == 1
    assert log.schema == spark.createDataFrame([], LOG_SCHEMA).schema or log.columns == ["file", "load", "blocks", "block", "bits"]
    incoming = delivered(spark, held[:500] + [(f"{rnd.randint(0, 9000)}", f"file{rnd.randint(0, 8)}", -1) for _ in range(3000)] + [(f"big{i}", "big", 0) for i in range(2500, 3500)] + [(None, "file1", 7)] * 2)
    read = []

    def rows_of(loads):
        read.extend(loads)
        return target["a"].unionByName(target["b"]) if len(loads) == 2 else target[loads[0]]

    got = new_rows_logged(incoming, log, rows_of, KEYS, "f")
    whole = target["a"].unionByName(target["b"])
    assert bag(got) == bag(new_rows(incoming, whole, KEYS))
    assert sorted(read) == ["a", "b"]
    # no false negative, and hardly a false positive
    asked = probed(incoming, log, KEYS, "f")
    sure = asked.where(F.size("_loads") == 0)
    assert sure.join(whole.select(*KEYS), KEYS, "left_semi").count() == 0
    perhaps = asked.where(F.size("_loads") > 0)
    assert perhaps.join(whole.select(*KEYS), KEYS, "left_anti").count() <= 5


def test_false_positives_do_no_harm(spark):
    held = delivered(spark, [("1", "x", 0)])
    full = log_entries(held, KEYS, "f", "l").withColumn("bits", F.unhex(F.lit("FF" * 4096)))  # every key is "perhaps"
    incoming = delivered(spark, [("1", "x", 1), ("2", "x", 2), ("2", "x", 3)])
    assert bag(new_rows_logged(incoming, full, lambda loads: held, KEYS, "f")) == bag(delivered(spark, [("2", "x", 2), ("2", "x", 3)]))


ORDERS = [
    [("v", False, False), ("k", False, False)],
    [("v", False, True), ("k", True, None)],
    [("v", True, None), ("s", False, None), ("k", False, None)],
    [("s", True, False), ("v", False, None), ("k", False, None)],
    [("d", False, True), ("k", True, False)],
]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_lazy_ntile(spark, order, ranges):
    rnd = random.Random(8)
    values = [None, None, 1.0, 1.0, 1.0, -0.5, 2.25, float("nan")]
    rows = [(i, rnd.choice(values) if i % 3 else rnd.random() * 9 - 4, rnd.choice(["", "é", "ab", "abcdefgh", "abcdefgi", None, "Z"]), day(rnd.randint(0, 9)) if i % 5 else None) for i in range(700)]
    df = spark.createDataFrame(rows, "k int, v double, s string, d date")

    def column(c, falling, nulls_first):
        first = falling if nulls_first is None else nulls_first
        col = F.col(c)
        return (col.desc_nulls_first() if first else col.desc_nulls_last()) if falling else (col.asc_nulls_first() if first else col.asc_nulls_last())

    for n in (4, 9):
        want = df.withColumn("q", F.ntile(n).over(Window.orderBy(*[column(*o) for o in order])))
        got = global_ntile(df, n, order, "q", num_partitions=ranges)
        assert got.columns == ["k", "v", "s", "d", "q"]
        assert bag(got.select("k", "q")) == bag(want.select("k", "q"))


def test_ntile_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ntile-build", "no job")
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    out = global_ntile(df, 4, [("v", False, False), ("k", False, False)], "q")
    assert not tracker.getJobIdsForGroup("ntile-build")
    assert out.groupBy("q").count().where("count = 250").count() == 4
    assert tracker.getJobIdsForGroup("ntile-build")
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("falling, nulls_first", [(False, False), (False, True), (True, None), (True, False)])
def test_segmented_lag(spark, falling, nulls_first):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), day(rnd.randint(0, 300)) if i % 9 else None, i, i % 4 or None) for i in range(400)]
    rows += [("hot", day(i), i, i) for i in range(900)]  # most of the rows
    df = spark.createDataFrame(rows, "k string, d date, i int, v int")
    order = [("d", falling, nulls_first), ("i", falling, None)]
    lags = {"v": "pv", "d": "pd"}
    want = with_previous(df, ["k"], order, lags)
    got = with_previous_segmented(df, ["k"], order, lags, F.trunc("d", "MM"))
    assert got.columns == want.columns and bag(got) == bag(want)
    assert with_previous_segmented(df.limit(0), ["k"], order, lags, F.trunc("d", "MM")).collect() == []


def test_segmented_lag_spreads_a_hot_key(spark):
    df = spark.createDataFrame([("hot", day(i), i) for i in range(600)], "k string, d date, v int")
    out = with_previous_segmented(df, ["k"], [("d", False, False)], {"v": "pv"}, F.trunc("d", "MM"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_segment" in plan.split("hashpartitioning(k", 1)[1].split(")")[0]

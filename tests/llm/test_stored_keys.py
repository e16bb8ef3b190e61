"""Stages whose jobs share row keys stand a scan that is split otherwise from one job to the next."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfspark.llm import decontamination, jaccard_join
from shelfspark.llm.common import stored

COST = "spark.sql.files.openCostInBytes"


@pytest.fixture
def tables(spark, tmp_path):
    words = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(60)]
    rows = [(i, words[i // 2 if i < 40 else i]) for i in range(60)]  # 0..39 are pairs of copies
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, words[50]), (2, words[55])], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def resplit(spark, monkeypatch, module, name):
    """Scans are planned with all files in one split until the operator has run, and with a split a file after it."""
    run = getattr(module, name)

    def then(*a, **k):
        spark.conf.set(COST, "1")
        found = run(*a, **k).localCheckpoint()
        spark.conf.set(COST, "128m")
        return found

    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    monkeypatch.setattr(module, name, then)


@pytest.fixture(autouse=True)
def settings(spark):
    yield
    for name in (COST, "spark.sql.files.minPartitionNum"):
        spark.conf.unset(name)


def test_near_duplicates(spark, tables, monkeypatch):
    resplit(spark, monkeypatch, jaccard_join, "join")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, tables).collect())
    assert got == [*range(0, 40, 2), *range(40, 60)]


def test_decontamination(spark, tables, monkeypatch):
    resplit(spark, monkeypatch, decontamination, "decontaminate")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.decontamination_stage(spark, docs, tables).collect())
    assert got == [i for i in range(60) if i not in (50, 55)]


def test_the_index_is_written_in_small_row_groups(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(decontamination, "stored", lambda *a, **k: kept.append(stored(*a, **k)) or kept[-1])
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(30_000)), lambda x: F.xxhash64(x, "doc_id").cast("string")))
    docs = spark.range(0, 30, 1, 1).toDF("doc_id").withColumn("text", text)
    items = docs.where("doc_id = 7").selectExpr("doc_id AS item_id", "substring_index(text, ' ', 20) AS text")
    found = decontamination.decontaminate(docs, items, block_tokens=1)
    assert [r.doc_id for r in found.where("n_hit = 20").collect()] == [7] and found.count() == 30
    groups = [m.row_group(g) for f in kept[0].inputFiles() if (m := pq.read_metadata(f.removeprefix("file://"))) for g in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 30 and max(g.total_byte_size for g in groups) < 12 << 20

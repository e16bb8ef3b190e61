"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents`` and the rows that it keeps, unchanged.  Repeated rows,
null ids, null and empty texts are handled as the operators say: rows without words fail the quality rules; repeated
rows are copies of which one stays.  An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import bpe, decontamination, jaccard_join, quality_rules, rule_ensemble
from shelfspark.llm.common import held_out, kept_rows, keyed, stored, table
from shelfspark.llm.queries import POLICY, QUALITY_LEAST, RANKS


#: The near-duplicate stage's shingle size and least Jaccard similarity in percent (op9_jaccard_join has its own).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule policy keeps (operator 6)."""
    ledger = quality_rules.ledger(keyed(docs).select("row", "text"), id_col="row")
    return kept_rows(quality_rules.apply_policy(ledger, POLICY), F.col("kept")).select("row.*")


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score QUALITY_LEAST or more (operator 5); learned from all labelled documents, so that the
    junk that the rules have rejected still teaches."""
    model = rule_ensemble.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("id")))
    scored = rule_ensemble.score(keyed(docs).select("row", "text"), model, id_col="row")
    return kept_rows(scored, F.col("score") >= QUALITY_LEAST).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join (operator 9): that of the least id, of repeated ids one."""
    rows = stored(keyed(docs).drop("text"), "near-rows")
    linked = jaccard_join.join(rows.select("key", "row.text"), id_col="key", percent=NEAR_PERCENT, words=NEAR_WORDS)
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), F.col("key").alias("key"))
    first = rows.select("key", order.alias("at")).join(linked.select("key", "component_id"), "key").groupBy("component_id").agg(F.min("at").alias("at"))
    return rows.join(first.select(F.col("at.key").alias("key")), "key", "left_semi").select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window (operator 1)."""
    rows = stored(keyed(docs).drop("text"), "bench-rows")
    found = decontamination.decontaminate(rows.select("key", "row.text"), table(spark, sf_dir, "benchmark"), id_col="key")
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("key"))
    return rows.join(hit, "key", "left_anti").select("row.*")


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit) and whether decoding gave the text (operator 8)."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    row = F.struct(F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha"))
    encoded = bpe.encode(docs.select(row.alias("row"), "text"), path, pattern, id_col="row")
    both = bpe.decode(encoded, path, pattern)
    return both.select("row.doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("row.sha")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rule_stage),
    ("quality_classifier", quality_classifier_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", byte_bpe_stage),
]

#: The classifier and the tokenizer can't be said in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The thin contract queries ``opN_<name>``: each reads its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontamination, fill_in_middle, html_extraction, jaccard_join, language_id, oracles, quality_rules, rule_ensemble, sharding, token_counts, token_files, url_rules, whitening
from .common import held_out, table

POLICY = "v2"
QUALITY_LEAST = 0.7
RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
WORD_BPE, END_ID = "word_bpe_49k.json", 2
SHARDS = 16
SHARD_SEED = 20240917


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = language_id.identify(table(spark, sf_dir, "documents"), ~held_out(F.col("id")))
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram counts over the pieces and scores of PIECES (the files hold no vocabulary of a unigram model)."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extraction.extract(table(spark, sf_dir, "pages"), keep=("url",))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = rule_ensemble.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("id")))
    scored = rule_ensemble.score(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")), POLICY)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.failed("base").alias("base_failed"), (~quality_rules.failed("base") & F.col("kept")).alias("kept"),
        "fail_bits",
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shard(docs, ["doc_id", "size", "text_crc32"], SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    both = bpe.decode(encoded, path, pattern)
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "confidence")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    again = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), END_ID)
    back = token_files.read(folder, index, ids=False)
    return back.select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_language_id, op3_token_counts, op4_html_extraction, op5_quality_classifier, op6_quality_rules,
        op7_sharding, op8_byte_bpe, op9_jaccard_join, op10_url_filters, op11_embedding_whitening, op12_fill_in_middle, op13_token_files,
    )
}
ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL

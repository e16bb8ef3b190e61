"""Languages that are rare among the rows that may be learned."""

from pyspark.sql import functions as F

from shelfspark.llm import language_id

SPEC = "doc_id long, text string, lang string, id string, h long, place int"


def test_a_rare_language_is_learned_from_a_small_sample(spark):
    english = [(i, f"the cat and the other {i} things that they have with them", "en", "x", 1, 1) for i in range(4000)]
    french = [(5000 + i, f"les chats où l'été déjà çà et là {i} êtes-vous très fâché", "fr", "x", 1, 1) for i in range(3)]
    one = [(6000, "ящик жёлтый щука объём", "ru", "x", 1, 1)]
    docs = spark.createDataFrame([*english, *french, *one], SPEC)
    held = language_id.sample(docs.select(F.col("doc_id").alias("id"), "text", "lang"), 300)
    count = {lang: sum(r["lang"] == lang for r in held) for lang in ("en", "fr", "ru")}
    assert count["fr"] == 3 and count["ru"] == 1 and 290 < count["en"] <= 300
    # one row makes a language that can be predicted, though its weights may stay below the penalty
    assert language_id.train(docs.select(F.col("doc_id").alias("id"), "text", "lang"), 300).languages == ["en", "fr", "ru"]
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, F.lit(True), rows=300).collect()}
    assert {got[i] for i in (5000, 5001, 5002)} == {"fr"} and {got[i] for i in range(4000)} == {"en"}


def test_no_labels_one_label_and_an_empty_table(spark):
    rows = [(1, "some words", None, "x", 1, 1), (2, None, "en", "x", 1, 1), (3, "12 34", "en", "x", 1, 1), (None, "", None, None, None, None)]
    docs = spark.createDataFrame(rows, SPEC)
    assert {r.lang_pred for r in language_id.identify(docs, F.lit(True)).collect()} == {"und"}
    docs = spark.createDataFrame([*rows, (4, "more words", "en", "x", 1, 1), (4, "more words", "en", "x", 1, 1)], SPEC)
    got = sorted((r.doc_id or 0, r.lang_pred) for r in language_id.identify(docs, F.lit(True)).collect())
    assert got == [(0, "und"), (1, "en"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert language_id.identify(spark.createDataFrame([], SPEC), F.lit(True)).collect() == []

"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the measurements and one long of failure bits (bit k =
rule k failed).  A policy is a versioned mask over the bits, so applying another policy version, or asking what would
change if a rule were dropped, needs only integer operations on the ledger and never reads a text again.

Everything is built from DataFrame functions in one projection: no shuffle, no Python.

Edge cases: a null text has no words (all measurements 0, fails ``too_short``); an empty text likewise; repeated rows
give repeated ledger rows; an empty table gives an empty ledger; extra columns of the input are ignored.  Repeated
5-word windows are found on 64-bit hashes of the windows of one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only

WINDOW = 5
#: The six white-space characters that end a word, and the symbol characters.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements; ``bit`` its place in the ledger and never reused."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "too_short", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 20 * n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule(5, "capitals", "100 * n_capitals > 40 * word_chars"),
)

#: Policy versions: the rules that reject a document.  ``base`` holds the two rules of the base verdict.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_short", "repeated_windows"),
    "v1": ("too_short", "repeated_windows", "symbols"),
    "v2": ("too_short", "repeated_windows", "symbols", "duplicate_lines", "word_length", "capitals"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def mask(policy: str) -> int:
    return sum(1 << r.bit for r in RULES if r.name in POLICIES[policy])


def words(text: Column) -> Column:
    """Maximal runs without space, tab, LF, VT, FF or CR; none for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, and MEASURES as longs.  The id may be of any type, also a struct of a whole row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = only(docs, id_col, text_col).toDF("id", "text").withColumn("words", words(F.col("text")))
    df = df.select(
        "id",
        F.col("words"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    # one 64-bit hash per window; a text without a repeated hash needs no positions
    spots = F.sequence(F.lit(1), F.size("words") - (WINDOW - 1))
    df = df.withColumn(
        "hashes",
        F.when(F.size("words") > WINDOW, F.transform(spots, lambda i: F.xxhash64(F.slice(F.col("words"), i, F.lit(WINDOW))))),
    )
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    df = df.withColumn(
        "sorted", F.when(repeated, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    )

    def beside(e: Column, i: Column, step: int) -> Column:
        return F.coalesce(F.get(F.col("sorted"), i + step)["h"] == e["h"], F.lit(False))

    found = F.filter("sorted", lambda e, i: beside(e, i, -1) | beside(e, i, 1))
    df = df.withColumn("starts", F.sort_array(F.transform(found, lambda e: e["i"])))
    # words covered by the repeated windows: overlapping windows count their words once
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return df.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "n_capitals",
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit k is set if rule k fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs, id_col, text_col).withColumn("fail_bits", total)


def failed(policy: str, bits: Column | None = None) -> Column:
    """Whether any rule of the policy failed."""
    return (F.col("fail_bits") if bits is None else bits).bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``kept`` under a policy version; no text is read."""
    return rows.withColumn("kept", ~failed(policy))


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects (kept if it were dropped).
    One pass; bits alone are aggregated."""
    m = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    chosen = [r for r in RULES if r.name in POLICIES[policy]]
    sums = [F.count(F.lit(1)).alias("n")]
    for r in chosen:
        bit = F.lit(1 << r.bit).cast("long")
        sums += [F.count(F.when(m.bitwiseAND(bit) != 0, 1)).alias(f"f_{r.bit}"), F.count(F.when(m == bit, 1)).alias(f"o_{r.bit}")]
    parts = ", ".join(f"'{r.name}', f_{r.bit}, o_{r.bit}" for r in chosen)
    return rows.agg(*sums).selectExpr("n AS n_documents", f"stack({len(chosen)}, {parts}) AS (rule, n_failed, n_only)")

"""Quality classifier: a sparse ensemble of rules compiled into column expressions.

1. ``statistics``: a dozen ratios of each text, as Spark columns.
2. Shallow random-forest trees are grown on the statistics of labelled texts; every path from a root to a node is a
   rule: a conjunction of bounds on statistics.
3. A lasso logistic regression over the rules' 0/1 values keeps few of them, with weights.
4. ``compile_score`` turns intercept, rules and weights into one column expression; scoring runs no Python and no
   model object.

Edge cases: null and empty texts have all statistics 0 and are scored like any other; null or other labels than 0 and 1
are left out, an id labelled both ways counts as 0; without two classes of labels every text gets the share of label 1
(0.5 without labels); repeated rows are scored alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, stored
from .quality_rules import words

#: Labelled rows that trees and weights are fitted on, at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, LASSO = 20, 4, 0.0001
STATISTICS = (
    "symbol_ratio", "bang_ratio", "capital_ratio", "digit_ratio", "distinct_ratio", "mean_word", "line_words",
    "repeated_lines", "stop_ratio", "log_words",
)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep`` columns and STATISTICS (doubles, 0 where there is nothing to divide)."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    df = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), *keep)
    df = df.withColumn("_words", words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    n = F.size("_words").cast("double")
    chars = F.length(F.array_join("_words", "")).cast("double")

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a.cast("double") / b).otherwise(0.0)

    def seen(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return df.select(
        F.col("_id").alias(id_col), *keep,
        ratio(seen(r"[^\p{L}\p{N}\p{M}\s.,;:!?'\"()\-]"), n).alias("symbol_ratio"),
        ratio(seen("[!?]"), n).alias("bang_ratio"),
        ratio(seen(r"\p{Lu}"), chars).alias("capital_ratio"),
        ratio(seen("[0-9]"), chars).alias("digit_ratio"),
        ratio(F.size(F.array_distinct("_words")), F.sqrt(n)).alias("distinct_ratio"),
        ratio(chars, n).alias("mean_word"),
        ratio(n, F.size("_lines").cast("double")).alias("line_words"),
        ratio(F.size("_lines") - F.size(F.array_distinct("_lines")), F.size("_lines").cast("double")).alias("repeated_lines"),
        ratio(seen(r"(?<![^\s])\p{L}{1,3}(?![^\s])"), n).alias("stop_ratio"),
        F.log1p(n).alias("log_words"),
    )


@dataclass(frozen=True)
class Rule:
    """Bounds (statistic, '<=' or '>', value), all of which hold where the rule does."""

    bounds: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, value in self.bounds:
            out = out & (F.col(name) <= value if op == "<=" else F.col(name) > value)
        return out


def tree_rules(debug: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """Every path of a printed forest from a root to an inner node's branch, each as its tightest bounds; no repeats."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, str, str, float]] = []
    for line in debug.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not found:
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(found[2])], found[3], float(found[4]))]
        tight: dict[tuple[str, str], float] = {}
        for _, name, op, value in path:
            pick = min if op == "<=" else max
            tight[name, op] = pick(tight.get((name, op), value), value)
        rules[Rule(tuple(sorted((a, b, v) for (a, b), v in tight.items())))] = None
    return list(rules)


@dataclass(frozen=True)
class Model:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """Rules and weights from (label, STATISTICS) rows."""
    shares = dict(rows.groupBy("label").count().collect())
    total = sum(shares.values())
    if len(shares) < 2:
        p = min(0.99, max(0.01, (shares.get(1, 0) + 0.5) / (total + 1)))
        return Model(float(np.log(p / (1 - p))), ())
    table = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows).select("label", "x", *STATISTICS)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=5, featureSubsetStrategy="onethird"
    ).fit(table)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        p = (shares.get(1, 0) + 0.5) / (total + 1)
        return Model(float(np.log(p / (1 - p))), ())
    hold = table.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    hold = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(hold)
    weights = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False
    ).fit(hold.select("label", "rules"))
    kept = tuple((r, float(w)) for r, w in zip(rules, weights.coefficients.toArray(), strict=True) if w)
    return Model(float(weights.intercept), kept)


def compile_score(model: Model) -> Column:
    """1 / (1 + exp(-(intercept + weights of the rules that hold)))."""
    z = F.lit(model.intercept)
    for rule, weight in model.weighted:
        z = z + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def training_rows(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """Statistics and label of at most ``rows`` labelled documents, chosen by a hash of the id."""
    marked = only(labels, id_col, label_col).toDF("id", "label").where(F.col("label").isin(0, 1) & learn_from)
    marked = marked.groupBy("id").agg(F.min("label").cast("int").alias("label")).withColumn("h", F.xxhash64("id"))
    bound = marked.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    near = only(docs, id_col, text_col).toDF("id", "text").where(F.xxhash64("id") <= F.lit(bound).cast("long"))
    measured = statistics(near, "id", "text")
    chosen = marked.where(F.col("h") <= F.lit(bound).cast("long")).select("id", "label")
    # a bounded table, so a fixed number of partitions serves any corpus
    return measured.join(chosen, "id").select("label", *STATISTICS).limit(rows).coalesce(4)


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """``learn_from`` (over ``id``) says which rows may be learned from."""
    return fit(stored(training_rows(docs, labels, learn_from, id_col, text_col, label_col, rows), "quality-sample"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep`` columns and score."""
    return statistics(docs, id_col, text_col, keep).select(id_col, *keep, compile_score(model).alias("score"))

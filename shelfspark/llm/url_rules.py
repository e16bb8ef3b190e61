"""URL filtering: a curated rule list, and association rules mined from the URLs that it judges.

``split_url`` takes host and path, ``fit_rules`` matches the curated list (longest rule wins).  For the other URLs,
Spark's FP-growth mines frequent token combinations together with the labels (the verdicts of the URLs that the list
judges); combinations whose confidence for ``block`` is high enough become rules, rules that a shorter rule makes
redundant are pruned, and the survivors match URLs through an inverted index on one token of each rule.

Only DataFrame functions and Spark ML's FP-growth; no Python code runs on the executors.

Edge cases: a null URL or one without ``://`` has an empty host and path and the token ``host=``; repeated rows give
repeated results; an empty table, or one without labelled URLs, mines nothing and every unruled URL is allowed; extra
columns are ignored.  Tokens are sets: a token that occurs twice in a URL counts once.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, only

#: Fixed values: (verdict, host, path) of the curated list.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
BLOCK, ALLOW = "label=block", "label=allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def listed(host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest curated rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The set of a URL's tokens: scheme, host, every parent domain, each path folder, the file's ending."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, n - i + 1), ".")))
    first = F.concat(F.lit("sub="), F.get(labels, F.lit(0)))
    parts = F.split(path, "/")
    folders = F.transform(
        F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0))), lambda x, i: F.concat(F.lit("dir"), i.cast("string"), F.lit("="), x)
    )
    ending = F.concat(F.lit("end="), F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1))
    scheme = F.concat(F.lit("scheme="), F.regexp_extract(F.coalesce(url, F.lit("")), r"^([^:/?#]*)://", 1))
    return F.array_distinct(F.concat(F.array(scheme, first, ending), parents, folders))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (items, confidence, support) that predict ``block`` from (tokens, verdict) rows.

    Confidence is exact: itemset count with the label over itemset count.  A rule goes if some proper part of it
    predicts block with at least its confidence.  Rule count is bounded by the support threshold.
    """
    baskets = labelled.select(F.concat(F.col("tokens"), F.array(F.concat(F.lit("label="), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = model.associationRules.where(F.col("consequent")[0] == BLOCK).where(~F.array_contains("antecedent", ALLOW))
    rules = found.select(F.sort_array("antecedent").alias("items"), "confidence", "support")
    # redundant: a shorter rule at least as sure; parts are looked up by their first-sorted shared item
    part = rules.select(F.col("items").alias("part"), F.col("confidence").alias("part_confidence"), F.get("items", F.lit(0)).alias("key"))
    whole = rules.withColumn("key", F.explode("items"))
    worse = whole.join(part, "key").where(
        (F.size("part") < F.size("items"))
        & (F.size(F.array_except("part", "items")) == 0)
        & (F.col("part_confidence") >= F.col("confidence"))
    )
    return rules.join(worse.select("items").distinct(), "items", "left_anti")


def inverted_index(rules: DataFrame) -> DataFrame:
    """token -> rule.  A rule is posted under its rarest token over the rules; it fits a URL only if the URL has it."""
    posted = rules.withColumn("token", F.explode("items"))
    count = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rare = posted.join(count, "token").groupBy("items", "confidence", "support").agg(F.min(F.struct("n", "token")).alias("t"))
    return rare.select(F.col("t.token").alias("token"), F.col("items").alias("rule_items"), "confidence")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and ``confidence`` (of the mined rule that blocks, else null)."""
    host, path = split_url(F.col("url"))
    rows = only(pages, id_col, url_col).toDF("id", "url").groupBy("id", "url").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("listed", listed(F.col("host"), F.col("path"))).withColumn(
        "tokens", tokens(F.col("url"), F.col("host"), F.col("path"))
    )
    # identical (URL tokens, verdict) pairs stay separate baskets: support counts pages
    labelled = rows.where(F.col("listed").isNotNull()).select(
        F.explode(F.sequence(F.lit(1), F.col("copies"))), "tokens", F.col("listed.verdict").alias("verdict")
    )
    index = inverted_index(mine(labelled))
    hits = (
        rows.where(F.col("listed").isNull())
        .select("id", "url", "tokens", F.explode("tokens").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("rule_items", "tokens")) == 0)
        .groupBy("id", "url")
        .agg(F.max("confidence").alias("confidence"))
        .withColumnsRenamed({"id": "hit_id", "url": "hit_url"})
    )
    both = rows["id"].eqNullSafe(hits["hit_id"]) & rows["url"].eqNullSafe(hits["hit_url"])
    out = rows.join(hits, both, "left")
    verdict = F.coalesce(F.col("listed.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), "confidence",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")

"""Source freshness (max timestamp vs an as-of instant, warn/error hours).

``freshness`` scans a table.  At ingest no scan is needed: ``observe_newest`` collects a source's newest load time
while its landing rows are read for bronze, and ``freshness_table`` makes a row per declared source of these.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfspark import config


def freshness(df: DataFrame, ts: Column | str, source: str, as_of,
              warn_hours: int = config.FRESHNESS_WARN_HOURS,
              error_hours: int = config.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """One row: (source, max_loaded_at, age_hours, status) with status pass / warn / error.

    ``ts`` is any timestamp expression (e.g. a JSON date cast strictly);
    ``as_of`` is a wall-clock datetime or a Column (use ``F.current_timestamp()``
    for the live check).  Times are compared as wall-clock (``timestamp_ntz``)
    values, so the result does not depend on the session time zone.  A source
    with no rows is an error.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    if isinstance(as_of, Column):
        now = as_of.cast("timestamp_ntz")
    else:  # wall-clock literal: independent of the session time zone
        now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    agg = df.agg(F.max(t).cast("timestamp_ntz").alias("max_loaded_at"))
    return _rated(agg.select(F.lit(source).alias("source"), "max_loaded_at"), now, warn_hours, error_hours)


def _rated(rows: DataFrame, now: Column, warn_hours: int, error_hours: int) -> DataFrame:
    age = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), now).cast("double") / 3.6e9
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(F.col("age_hours") > error_hours, F.lit("error"))
              .when(F.col("age_hours") > warn_hours, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return rows.select("source", "max_loaded_at", F.round(age, 6).alias("age_hours")).withColumn("status", status)


def observe_newest(landing: DataFrame, entity: str) -> tuple[DataFrame, Observation]:
    """The landing rows, with the newest load time of the entity's declared field observed as they pass.

    The field is read as a wall-clock time; values that are none count as missing.
    """
    seen = Observation()
    field = F.nullif(F.trim(F.try_variant_get("value", f"$.{config.FRESHNESS_FIELDS[entity]}", "string")), F.lit(""))
    return landing.observe(seen, F.max(field.try_cast("timestamp_ntz")).cast("string").alias("newest")), seen


def newest(seen: Observation) -> _dt.datetime | None:
    """The observed time; call it after the action that read the rows."""
    value = seen.get["newest"]
    return _dt.datetime.fromisoformat(value) if value else None


def freshness_table(spark: SparkSession, loaded: Mapping[str, _dt.datetime | None], as_of: _dt.datetime,
                    warn_hours: int = config.FRESHNESS_WARN_HOURS,
                    error_hours: int = config.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """One row per source: (source, max_loaded_at, age_hours, status), as ``freshness`` gives them."""
    rows = spark.createDataFrame([(k, v) for k, v in loaded.items()], "source string, max_loaded_at timestamp_ntz")
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return _rated(rows, now, warn_hours, error_hours)

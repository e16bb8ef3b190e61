"""Incremental loads: anti-join append (I4), merge/upsert (I5), high-water mark."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark import config


def new_rows(source: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """I4: source rows whose ``keys`` are not in ``target`` (NOT EXISTS with plain ``=``).

    A NULL key never matches, so such rows are always re-inserted, as in the
    reference.  ``target=None`` (first run) keeps everything.
    """
    if target is None:
        return source
    return source.join(target.select(*keys), on=list(keys), how="left_anti")


def merge_upsert(target: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE by key on immutable files: target rows not re-delivered + all incoming rows.

    The result is a new DataFrame to be written to a fresh location (see
    ``sources.sinks.write_table``); schemas are aligned by name and new
    columns are allowed (``sync_all_columns``).
    """
    if target is None:
        return incoming
    kept = target.join(incoming.select(*keys).distinct(), on=list(keys), how="left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def after_high_watermark(source: DataFrame, target: DataFrame | None, date_col: str,
                         default: _dt.date = config.HIGH_WATERMARK_DEFAULT) -> DataFrame:
    """Only source rows strictly newer than the target's max ``date_col``.

    The mark is a scalar subquery (a one-row aggregate, run once before the
    scan), so the filter is a plain comparison with a value: no join, and a
    source partitioned by the date prunes its partitions.  Rows with a NULL
    date are never loaded incrementally.
    """
    if target is None:
        return source
    mark = target.agg(F.coalesce(F.max(date_col), F.lit(default))).scalar()
    return source.filter(F.col(date_col) > mark)

"""K1: deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark import config


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over the parts joined by '-', each part cast to text with NULL as a placeholder.

    Never NULL: a NULL natural key still gets a (shared) real key.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(config.SURROGATE_NULL))
        for c in cols
    ]
    return F.md5(F.concat_ws(config.SURROGATE_SEPARATOR, *parts))


def date_key(d: Column | str) -> Column:
    """Integer ``YYYYMMDD`` key of a date (NULL date -> NULL key)."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(c, "yyyyMMdd").cast("int")

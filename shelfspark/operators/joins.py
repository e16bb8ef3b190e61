"""Join operators: checked broadcast, star lookup, totals, range-to-equi, flatten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark import config


# Most distinct values a DATE column can hold (0001-01-01 .. 9999-12-31).
DATE_DOMAIN_ROWS = 3_652_059

def checked_broadcast(df: DataFrame, max_rows: int = config.BROADCAST_MAX_ROWS,
                      known_max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only for a side whose bound holds by construction (e.g. one row per date).

    No job is run to find out: without a bound the side stays plain and AQE
    broadcasts it from its measured shuffle size, or not.
    """
    if known_max_rows is not None and known_max_rows <= max_rows:
        return F.broadcast(df)
    return df


def star_lookup(fact: DataFrame, lookups: Sequence[tuple[DataFrame, str | Sequence[str], Sequence[str]]],
                max_rows: int = config.BROADCAST_MAX_ROWS, how: str = "left") -> DataFrame:
    """Fact LEFT JOIN each dimension on its natural key, adding the listed columns.

    ``lookups`` = [(dim, join_key(s), columns_to_add)].  Each dimension is
    projected to key + wanted columns; AQE broadcasts it if its measured size allows.
    """
    out = fact
    for dim, keys, cols in lookups:
        key_list = [keys] if isinstance(keys, str) else list(keys)
        extra = [c for c in cols if c not in key_list]
        side = dim.select(*key_list, *extra)
        # the dimension's attribute wins over a same-named fact column
        out = out.drop(*[c for c in extra if c in out.columns])
        out = out.join(side, on=key_list, how=how)
    return out


def with_total(df: DataFrame, measure: str, total_name: str) -> DataFrame:
    """Attach the grand total of ``measure``.

    The total is a scalar subquery (a one-row aggregate with map-side partial
    sums, run once and inlined as a value), so no join is planned at all.
    """
    return df.withColumn(total_name, df.agg(F.sum(measure)).scalar())


def with_group_total(df: DataFrame, group: str | Sequence[str], measure: str, total_name: str,
                     max_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    """Attach per-group totals via aggregate + equi join (NULL group -> NULL total).

    The aggregate uses map-side partial sums, so a hot group costs one partial
    row per task.  A date group has a static bound (one total per day), so its
    totals are broadcast and the detail side is never shuffled for it.  Other
    groups have no bound short of running the aggregate; counting it would
    recompute the whole input, so the join is left to AQE, which broadcasts
    the totals from their measured shuffle size.
    """
    keys = [group] if isinstance(group, str) else list(group)
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(total_name))
    if len(keys) == 1 and df.schema[keys[0]].dataType.typeName() == "date":
        known = DATE_DOMAIN_ROWS + 1  # one total per date (+ NULL), whatever the data size
        return df.join(checked_broadcast(totals, max(max_rows, known), known), on=keys, how="left")
    return df.join(totals, on=keys, how="left")


def _not_null(df: DataFrame, key: str):
    """The key with its type's default in place of NULL."""
    zero = {"string": "''", "boolean": "FALSE", "date": "DATE'1970-01-01'", "timestamp": "TIMESTAMP'1970-01-01 00:00:00'"}
    kind = df.schema[key].dataType
    return F.coalesce(df[key], F.expr(f"CAST({zero.get(kind.typeName(), '0')} AS {kind.simpleString()})"))


def share_of_group(df: DataFrame, group: str | Sequence[str], measure: str, out: str,
                   zero_value=0.0, round_to: int | None = 6,
                   max_rows: int = config.BROADCAST_MAX_ROWS, totals_of: DataFrame | None = None) -> DataFrame:
    """Row share (percent) of its group's total; ``zero_value`` when total <= 0 or NULL.

    Same result as ``sum() over (partition by group)`` but without putting a
    whole group (e.g. one date at 100 TB) into one window task.  ``totals_of``: the rows
    that make up the totals, where they are not those of ``df``.
    """
    tot = "_group_total"
    keys = [group] if isinstance(group, str) else list(group)
    # NULL groups are groups of their own, as in PARTITION BY: each key joins as (is NULL, value); equal keys that are
    # unique on the right let Catalyst drop the totals where the share is not asked for
    parts = totals_of if totals_of is not None else df
    totals = parts.groupBy(*[p.alias(f"_{n}{i}") for i, k in enumerate(keys) for n, p in (("g", parts[k].isNull()), ("v", _not_null(parts, k)))]
                           ).agg(F.sum(measure).alias(tot))
    if len(keys) == 1 and df.schema[keys[0]].dataType.typeName() == "date":
        totals = checked_broadcast(totals, max(max_rows, DATE_DOMAIN_ROWS + 1), DATE_DOMAIN_ROWS + 1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (df[k].isNull() == totals[f"_g{i}"]) & (_not_null(df, k) == totals[f"_v{i}"])
    joined = df.join(totals, same, "left").drop(*[f"_{n}{i}" for i in range(len(keys)) for n in "gv"])
    share = F.col(measure).cast("double") / F.col(tot).cast("double") * 100.0
    if round_to is not None:
        share = F.round(share, round_to)
    value = F.when(F.col(tot) > 0, share)
    if zero_value is not None:
        value = value.otherwise(F.lit(zero_value))
    return joined.withColumn(out, value).drop(tot)


def explode_date_range(df: DataFrame, start: str, end: str, out: str = "full_date") -> DataFrame:
    """J5 helper: one row per day in [start, end] (inclusive); none when end < start or NULL."""
    days = F.when(F.col(end) >= F.col(start),
                  F.sequence(F.col(start), F.col(end), F.expr("interval 1 day")))
    return df.withColumn(out, F.explode(days))


def range_to_calendar(ranges: DataFrame, calendar: DataFrame, start: str, end: str,
                      date_col: str = "full_date") -> DataFrame:
    """``ranges JOIN calendar ON date BETWEEN start AND end`` as an equi join.

    Each range is expanded to its days first, so the join is a hash join on the
    date instead of a nested loop over ranges x calendar.  Ranges are cut to the
    calendar's bounds before, so an open-ended range is no longer than it.
    """
    lo, hi = (calendar.agg(f(date_col)).scalar() for f in (F.min, F.max))
    cut = ranges.withColumns({
        "_from": F.when(F.col(start).isNotNull(), F.greatest(F.col(start), lo)),
        "_to": F.when(F.col(end).isNotNull(), F.least(F.col(end), hi)),
    })
    expanded = explode_date_range(cut, "_from", "_to", date_col).drop("_from", "_to")
    return expanded.join(checked_broadcast(calendar), on=date_col, how="inner")


def flatten_items(df: DataFrame, array_col: str, item_col: str = "item_data",
                  index_col: str | None = "item_number") -> DataFrame:
    """One row per array element (non-outer: empty/NULL arrays give no rows).

    ``index_col`` is the 1-based element position.  Written as an outer
    explode + position filter: a plain explode makes Catalyst add a
    ``size(array) > 0`` filter that evaluates the array expression (e.g. a
    JSON parse) a second time.
    """
    rest = [c for c in df.columns if c != array_col]
    out = (df.select(*rest, F.posexplode_outer(array_col).alias("_pos", item_col))
             .filter(F.col("_pos").isNotNull()))
    if index_col is None:
        return out.drop("_pos")
    return out.withColumn(index_col, F.col("_pos") + 1).drop("_pos")

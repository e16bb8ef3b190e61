"""Derived business metrics (M1-M32) as Column expressions.

``as_of`` arguments replace the warehouse's CURRENT_DATE so results are
reproducible; pass ``F.current_date()`` for the live behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark import config

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_or_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# ---------------------------------------------------------------------------
# generic helpers
# ---------------------------------------------------------------------------

def safe_ratio(num: ColumnOrName, den: ColumnOrName, times: float = 1.0,
               decimal_scale: int | None = None, round_to: int | None = None) -> Column:
    """``num / den * times`` when ``den > 0``, else NULL (no ANSI divide-by-zero).

    Computed in DOUBLE; ``decimal_scale`` casts to ``decimal(18, s)`` (the
    warehouse's published type), ``round_to`` rounds the double instead.
    """
    n, d = _col(num).cast("double"), _col(den).cast("double")
    out = F.when(d > 0, n / d * F.lit(float(times)))
    if decimal_scale is not None:
        return out.cast(f"decimal(18,{decimal_scale})")
    if round_to is not None:
        return F.round(out, round_to)
    return out


def flag(condition: Column, on_null: bool | None = False) -> Column:
    """Boolean flag; a NULL condition becomes ``on_null`` (FALSE by default)."""
    if on_null is None:
        return condition
    return F.coalesce(condition, F.lit(on_null))


def band(value: ColumnOrName, rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """First matching (label, condition) wins; ``default`` otherwise."""
    out = None
    for label, cond in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if default is not None:
        out = out.otherwise(F.lit(default))
    return out


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end`` (dates)."""
    return F.datediff(_col(end), _col(start))


# ---------------------------------------------------------------------------
# M1-M7  entities
# ---------------------------------------------------------------------------

def duration_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """M1: days from start to end when both are set and end is not before start."""
    s, e = _col(start), _col(end)
    return F.when(s.isNotNull() & e.isNotNull() & (e >= s), F.datediff(e, s))


def whole_years(since: ColumnOrName, as_of) -> Column:
    """M2/M5: completed years from ``since`` to ``as_of``; NULL when in the future.

    Calendar-year difference, minus one if this year's anniversary is still ahead
    (a 29 February anniversary falls on 28 February).
    """
    s, a = _col(since), _lit_or_col(as_of)
    years = F.year(a) - F.year(s)
    anniversary = F.add_months(s, years * 12)
    return F.when(s.isNotNull() & (s <= a), years - F.when(anniversary > a, 1).otherwise(0))


def age_band(age: ColumnOrName) -> Column:
    """M3: Young 18-35, Middle-aged 36-55, Senior 56+, else NULL."""
    a = _col(age)
    rules = [(label, a.between(lo, hi)) for label, lo, hi in config.AGE_BANDS]
    senior_label, senior_from = config.AGE_BAND_SENIOR
    rules.append((senior_label, a >= senior_from))
    return band(a, rules)


def store_size_band(size_sq_ft: ColumnOrName) -> Column:
    """M4: Small < 5000 <= Medium <= 10000 < Large; NULL size -> NULL."""
    s = _col(size_sq_ft)
    small, medium, large = config.STORE_SIZE_LABELS
    return band(s, [
        (small, s < config.STORE_SIZE_SMALL_BELOW),
        (medium, (s >= config.STORE_SIZE_SMALL_BELOW) & (s <= config.STORE_SIZE_LARGE_ABOVE)),
        (large, s > config.STORE_SIZE_LARGE_ABOVE),
    ])


def target_achievement_pct(current_sales: ColumnOrName, sales_target: ColumnOrName,
                           decimal_scale: int | None = 2, round_to: int | None = None) -> Column:
    """M6: current / target * 100 when target > 0."""
    return safe_ratio(current_sales, sales_target, 100.0, decimal_scale, round_to)


def performance_issue(achievement_pct: ColumnOrName) -> Column:
    """M7: achievement below 90%; NULL achievement -> FALSE."""
    return flag(_col(achievement_pct) < config.UNDERPERFORMING_BELOW_PCT)


# ---------------------------------------------------------------------------
# M8-M9  products
# ---------------------------------------------------------------------------

def margin_pct(price: ColumnOrName, cost: ColumnOrName, decimal_scale: int | None = 2,
               round_to: int | None = None) -> Column:
    """M8: (price - cost) / price * 100 when price > 0."""
    p, c = _col(price), _col(cost)
    return safe_ratio(p - c, p, 100.0, decimal_scale, round_to)


def low_stock(stock: ColumnOrName, reorder_level: ColumnOrName, on_null: bool | None = False) -> Column:
    """M9: stock below reorder level."""
    return flag(_col(stock) < _col(reorder_level), on_null)


# ---------------------------------------------------------------------------
# M10-M15  orders
# ---------------------------------------------------------------------------

def time_of_day(hour: ColumnOrName) -> Column:
    """Morning 5-11, Afternoon 12-16, Evening 17-21, otherwise (and NULL) Night."""
    h = _col(hour)
    rules = [(label, (h >= lo) & (h < hi)) for label, lo, hi in config.TIME_OF_DAY_BANDS]
    return band(h, rules, config.TIME_OF_DAY_DEFAULT)


def calendar_parts(d: ColumnOrName, prefix: str = "") -> dict[str, Column]:
    """ISO week, month, quarter, year of a date."""
    c = _col(d)
    return {
        f"{prefix}week": F.weekofyear(c),
        f"{prefix}month": F.month(c),
        f"{prefix}quarter": F.quarter(c),
        f"{prefix}year": F.year(c),
    }


def order_profit(line_revenue: ColumnOrName, order_rate: ColumnOrName, line_cost: ColumnOrName,
                 shipping: ColumnOrName, tax: ColumnOrName) -> Column:
    """Revenue after the order discount, minus cost, shipping and tax (decimal(18,2))."""
    net = _col(line_revenue) * (F.lit(1) - _col(order_rate))
    return (net - _col(line_cost) - _col(shipping) - _col(tax)).cast("decimal(18,2)")


def order_margin_pct(profit: ColumnOrName, line_revenue: ColumnOrName, round_to: int | None = 6) -> Column:
    """Profit / line revenue * 100 when revenue > 0."""
    return safe_ratio(profit, line_revenue, 100.0, None, round_to)


def delivery_status(delivered: ColumnOrName, estimate: ColumnOrName, as_of) -> Column:
    """On Time / Delayed / Potentially Delayed / In Transit."""
    dl, est, today = _col(delivered), _col(estimate), _lit_or_col(as_of)
    return (
        F.when(dl.isNotNull() & (dl <= est), F.lit(config.DELIVERY_ON_TIME))
        .when(dl.isNotNull() & (dl > est), F.lit(config.DELIVERY_DELAYED))
        .when(dl.isNull() & (today > est), F.lit(config.DELIVERY_POTENTIALLY_DELAYED))
        .otherwise(F.lit(config.DELIVERY_IN_TRANSIT))
    )


# ---------------------------------------------------------------------------
# M16-M21  inventory
# ---------------------------------------------------------------------------

def purchased(beginning: ColumnOrName, ending: ColumnOrName, sold: ColumnOrName) -> Column:
    """Inferred purchases = ending - beginning + that day's sales."""
    b, e = _col(beginning), _col(ending)
    return F.when(b.isNotNull() & e.isNotNull(), e - b + _col(sold))


def inventory_value(ending: ColumnOrName, cost: ColumnOrName) -> Column:
    """Ending stock times unit cost, decimal(18,2)."""
    e, c = _col(ending), _col(cost)
    return F.when(e.isNotNull() & c.isNotNull(), (e * c).cast("decimal(18,2)"))


def average_inventory(beginning: ColumnOrName, ending: ColumnOrName) -> Column:
    """(beginning + ending) / 2 as DOUBLE."""
    b, e = _col(beginning), _col(ending)
    return F.when(b.isNotNull() & e.isNotNull(), (b + e).cast("double") / 2.0)


def turnover(sold: ColumnOrName, avg_inventory: ColumnOrName, round_to: int | None = 6) -> Column:
    """Sold / average inventory when the average is positive."""
    return safe_ratio(sold, avg_inventory, 1.0, None, round_to)


def gap_days(previous: ColumnOrName, current: ColumnOrName) -> Column:
    """Days since the previous snapshot, 0 for the first one."""
    p = _col(previous)
    return F.when(p.isNull(), F.lit(0)).otherwise(F.datediff(_col(current), p))


def gap_flag(previous: ColumnOrName, current: ColumnOrName) -> Column:
    """More than one day since the previous snapshot; first snapshot FALSE."""
    p = _col(previous)
    return F.when(p.isNull(), F.lit(False)).otherwise(
        F.datediff(_col(current), p) > config.SNAPSHOT_GAP_DAYS)


def negative_purchase(purchased_qty: ColumnOrName) -> Column:
    """Inferred purchase below zero; NULL -> FALSE."""
    return flag(_col(purchased_qty) < 0)


# ---------------------------------------------------------------------------
# M23-M31  campaign, reports, calendar
# ---------------------------------------------------------------------------

def repeat_rate(repeat_customers: ColumnOrName, total_customers: ColumnOrName,
                round_to: int | None = 6) -> Column:
    """100 * repeat / total when total > 0."""
    return safe_ratio(repeat_customers, total_customers, 100.0, None, round_to)


def roi(sales: ColumnOrName, budget: ColumnOrName, round_to: int | None = 6) -> Column:
    """(sales - budget) / budget * 100 when budget > 0."""
    s, b = _col(sales), _col(budget)
    return safe_ratio(s - b, b, 100.0, None, round_to)


def turnover_category(ratio: ColumnOrName) -> Column:
    """NULL -> No Turnover Data, 0 -> No Movement, >= 1 -> High, else Low."""
    r = _col(ratio)
    no_data, none, high, low = config.TURNOVER_LABELS
    return (F.when(r.isNull(), F.lit(no_data)).when(r == 0, F.lit(none))
            .when(r >= config.TURNOVER_HIGH_AT, F.lit(high)).otherwise(F.lit(low)))


def movement_category(avg_ratio: ColumnOrName, quartile: ColumnOrName) -> Column:
    """NULL ratio -> No Movement; quartile 1 Slow, last Fast, else Medium."""
    r, q = _col(avg_ratio), _col(quartile)
    none, slow, fast, medium = config.MOVEMENT_LABELS
    return (F.when(r.isNull(), F.lit(none)).when(q == 1, F.lit(slow))
            .when(q == config.MOVEMENT_QUARTILES, F.lit(fast)).otherwise(F.lit(medium)))


def concentration_band(share_pct: ColumnOrName) -> Column:
    """>= 50 Very High, >= 30 High, >= 15 Medium, else (and NULL) Low."""
    s = _col(share_pct)
    return band(s, [(label, s >= lo) for label, lo in config.CONCENTRATION_BANDS], config.CONCENTRATION_DEFAULT)


def supply_status(gap: ColumnOrName) -> Column:
    """Delayed when the snapshot gap flag is set, else On Time."""
    return F.when(F.coalesce(_col(gap), F.lit(False)), F.lit(config.SUPPLY_DELAYED)).otherwise(
        F.lit(config.SUPPLY_ON_TIME))


def season(d: ColumnOrName) -> Column:
    """Season of a date's month."""
    m = F.month(_col(d))
    return band(m, [(label, m.isin(*months)) for label, months in config.SEASONS])


def holiday_flag(d: ColumnOrName, holidays=config.HOLIDAYS) -> Column:
    return F.coalesce(_col(d).isin(*[F.lit(h) for h in holidays]), F.lit(False))

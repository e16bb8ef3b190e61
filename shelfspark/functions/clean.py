"""Column-level cleaning and parsing (no Python UDFs: every function returns a
Spark ``Column`` built from SQL built-ins, so it stays inside whole-stage codegen).

Null-on-failure parsing uses ``try_cast`` / ``try_to_*`` so ANSI mode never
raises on bad input; the *strict* variants use ``cast`` and raise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark import config

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# S1-S4  trim / case / blank handling / concatenation
# ---------------------------------------------------------------------------

def blank_to_null(c: ColumnOrName) -> Column:
    """Trim, and turn the empty string into NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def clean_text(c: ColumnOrName) -> Column:
    """Trimmed text with blanks as NULL (the usual first step of every field)."""
    return blank_to_null(c)


def full_name(first: ColumnOrName, last: ColumnOrName, strict: bool = False) -> Column:
    """``first || ' ' || last``.

    ``strict=True`` is plain CONCAT: NULL when either part is NULL.
    ``strict=False`` treats a NULL part as '' and trims, NULL when nothing is left.
    """
    f, l = _col(first), _col(last)
    if strict:
        return F.concat(f, F.lit(" "), l)
    joined = F.trim(F.concat(F.coalesce(f, F.lit("")), F.lit(" "), F.coalesce(l, F.lit(""))))
    return F.nullif(joined, F.lit(""))


def join_parts(sep: str, *parts: ColumnOrName, on_null: str = "null") -> Column:
    """CONCAT_WS with the dialect's NULL rule.

    ``on_null='null'``: NULL if any part is NULL (warehouse CONCAT_WS).
    ``on_null='skip'``: NULL parts are left out (Spark CONCAT_WS).
    """
    cols = [_col(p) for p in parts]
    joined = F.concat_ws(sep, *cols)
    if on_null == "skip":
        return joined
    if on_null != "null":
        raise ValueError("on_null must be 'null' or 'skip'")
    any_null = None
    for c in cols:
        any_null = c.isNull() if any_null is None else (any_null | c.isNull())
    return F.when(any_null, F.lit(None).cast("string")).otherwise(joined)


# ---------------------------------------------------------------------------
# S6  title case with punctuation word breaks
# ---------------------------------------------------------------------------

def _break_class(breaks: str) -> str:
    return "[" + "".join("\\" + ch if ch in "\\^-[]" else ch for ch in breaks) + "]"


def title_case(c: ColumnOrName, breaks: str = config.TITLE_CASE_BREAKS) -> Column:
    """INITCAP that starts a word after any delimiter, not only whitespace.

    The text is lower-cased and split *after* each delimiter (zero-width
    look-behind keeps the delimiters), each piece gets its first character
    upper-cased, and the pieces are glued back.
    """
    cls = _break_class(breaks)
    pieces = F.split(F.lower(_col(c)), f"(?<={cls})")
    capped = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.when(_col(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(capped, ""))


# ---------------------------------------------------------------------------
# S7, S8, S11  regex cleaning
# ---------------------------------------------------------------------------

def digits(c: ColumnOrName) -> Column:
    """Keep only 0-9; blank result becomes NULL."""
    return F.nullif(F.regexp_replace(F.trim(_col(c)), r"[^0-9]", ""), F.lit(""))


def clean_name(c: ColumnOrName, allowed: str = "A-Za-z' -", strip_first: bool = True) -> Column:
    """Drop characters outside ``allowed`` and title-case.

    The order matters: stripped first, a removed character joins its neighbours
    into one word; title-cased first, each part keeps its capital.
    """
    pattern, text = f"[^{allowed}]", F.trim(_col(c))
    out = title_case(F.regexp_replace(text, pattern, "")) if strip_first else F.regexp_replace(title_case(text), pattern, "")
    return F.nullif(out, F.lit(""))


def parse_money(c: ColumnOrName, precision: int = 18, scale: int = 2,
                default: str | None = None) -> Column:
    """Strip ``$`` and ``,``, then a null-on-failure decimal cast."""
    cleaned = F.nullif(F.regexp_replace(F.trim(_col(c)), r"[$,]", ""), F.lit(""))
    out = cleaned.try_cast(f"decimal({precision},{scale})")
    if default is not None:
        out = F.coalesce(out, F.lit(default).cast(f"decimal({precision},{scale})"))
    return out


def parse_measure(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Number inside text with a unit (``'1.5 kg'`` -> 1.50): keep digits, dot, minus."""
    cleaned = F.nullif(F.regexp_replace(F.trim(_col(c)), r"[^0-9.\-]", ""), F.lit(""))
    return cleaned.try_cast(f"decimal({precision},{scale})")


def phone(c: ColumnOrName, exact: int | None = 10, minimum: int | None = None) -> Column:
    """Digits-only phone, NULL unless it has ``exact`` digits (or at least ``minimum``)."""
    d = digits(c)
    if minimum is not None:
        ok = F.length(d) >= minimum
    else:
        ok = F.length(d) == exact
    return F.when(d.isNotNull() & ok, d)


def phone_valid(c: ColumnOrName, exact: int | None = 10, minimum: int | None = None) -> Column:
    """C4: row flag for ``phone``; never NULL."""
    return phone(c, exact, minimum).isNotNull()


# ---------------------------------------------------------------------------
# S9, S10  regex extraction / match
# ---------------------------------------------------------------------------

def file_date(path: ColumnOrName, pattern: str = config.FILE_DATE_PATTERN) -> Column:
    """First ``YYYY-MM-DD`` in a file path as a date; NULL when absent or invalid."""
    return F.regexp_substr(_col(path), F.lit(pattern)).try_cast("date")


def valid_email(c: ColumnOrName, lenient: bool = False) -> Column:
    """Lower-cased, trimmed e-mail when it has the right shape, else NULL."""
    pattern = config.EMAIL_PATTERN_LENIENT if lenient else config.EMAIL_PATTERN_STRICT
    e = F.lower(blank_to_null(c))
    return F.when(e.isNotNull() & e.rlike(pattern), e)


def email_valid_flag(c: ColumnOrName, lenient: bool = False) -> Column:
    """C4: never-NULL flag for ``valid_email``."""
    return valid_email(c, lenient).isNotNull()


# ---------------------------------------------------------------------------
# S12-S16  typed parsing
# ---------------------------------------------------------------------------

DEFAULT_DATE_FORMATS: tuple[str, ...] = ("MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "MMM d, yyyy")


def parse_date(c: ColumnOrName, formats: Sequence[str] = DEFAULT_DATE_FORMATS,
               strict: bool = False) -> Column:
    """ISO text (or a timestamp prefix) first, then each extra format.

    ``strict`` is a plain ``cast``: malformed text raises under ANSI.
    """
    x = blank_to_null(c)
    if strict:
        return x.cast("date")
    options = [x.try_cast("date")] + [F.try_to_date(x, fmt) for fmt in formats]
    return F.coalesce(*options)


def parse_ts(c: ColumnOrName, zoned: bool = False) -> Column:
    """Null-on-failure timestamp.

    ``zoned=False`` gives the wall-clock ``timestamp_ntz`` (the hour as written),
    ``zoned=True`` the instant (offset applied, shown in the session zone).
    """
    x = blank_to_null(c)
    return x.try_cast("timestamp" if zoned else "timestamp_ntz")


def parse_decimal(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Null-on-failure decimal; rounds half up; blank -> NULL."""
    return blank_to_null(c).try_cast(f"decimal({precision},{scale})")


def parse_number(c: ColumnOrName) -> Column:
    """Whole number, rounding half up ('3.7' -> 4), published as bigint."""
    return blank_to_null(c).try_cast("decimal(38,0)").try_cast("bigint")


_TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
_FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def parse_bool(c: ColumnOrName, strict: bool = False) -> Column:
    """Boolean from the usual words (case-insensitive), NULL otherwise.

    ``strict=True`` raises on unknown words like a plain cast.
    """
    x = F.lower(blank_to_null(c))
    out = F.when(x.isin(*_TRUE_WORDS), F.lit(True)).when(x.isin(*_FALSE_WORDS), F.lit(False))
    if strict:
        return F.when(x.isNull() | x.isin(*_TRUE_WORDS, *_FALSE_WORDS), out).otherwise(x.cast("boolean"))
    return out


def percent_to_rate(c: ColumnOrName) -> Column:
    """Percent text -> rate decimal(18,8) (``'15'`` -> 0.15), default 0."""
    pct = blank_to_null(c).try_cast("decimal(18,6)")
    return F.coalesce((pct * F.lit(0.01).cast("decimal(18,6)")).cast("decimal(18,8)"),
                      F.lit(0).cast("decimal(18,8)"))


# ---------------------------------------------------------------------------
# S21  JSON paths
# ---------------------------------------------------------------------------

def parse_payload(c: ColumnOrName) -> Column:
    """Raw JSON text -> VARIANT (NULL for malformed text)."""
    return F.try_parse_json(_col(c))


def json_path(payload: ColumnOrName, path: str, type_: str = "string") -> Column:
    """Typed value at a JSON path of a VARIANT payload, NULL when missing or mistyped.

    ``path`` uses ``$.a.b[0]`` syntax.
    """
    return F.try_variant_get(_col(payload), path, type_)


def json_text(payload: ColumnOrName, path: str) -> Column:
    """Value at a path as text (objects/arrays as JSON text, scalars unquoted)."""
    return F.try_variant_get(_col(payload), path, "string")


def json_field(payload: ColumnOrName, path: str) -> Column:
    """Trimmed text at a path with blanks as NULL."""
    return blank_to_null(json_text(payload, path))


def first_non_null(*cols: ColumnOrName) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def landing_table_name(folder: ColumnOrName) -> Column:
    """I1 name rule: ``EXT_`` + upper-cased folder with '-' and ' ' as '_'."""
    return F.concat(F.lit(config.LANDING_TABLE_PREFIX),
                    F.translate(F.upper(_col(folder)), "- ", "__"))

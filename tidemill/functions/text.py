"""String predicates and arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["is_blank", "is_empty", "matches_allowed", "safe_ratio", "int_div", "word_tokens", "WORD_PATTERN", "SPLIT_PATTERN", "last_csv_token"]

# A token is a maximal run of letters or digits (any script).
WORD_PATTERN = r"[\p{L}\p{N}]+"
SPLIT_PATTERN = r"[^\p{L}\p{N}]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_empty(col) -> Column:
    """F13 isEmpty: null or zero length."""
    c = _c(col)
    return c.isNull() | (F.length(c) == 0)


def is_blank(col) -> Column:
    """F13 isBlank: null or only white space and control characters (up to U+0020)."""
    c = _c(col)
    return c.isNull() | c.rlike(r"^[\x00-\x20]*$")


def matches_allowed(col, pattern: str = r"^[\p{L}\p{N}\p{P}\p{Zs}\n\r\t]*$") -> Column:
    """true when every character of the value is in the allowed class."""
    return _c(col).rlike(pattern)


def safe_ratio(num, den) -> Column:
    """num/den as double, 0.0 when den is not positive."""
    return F.when(_c(den) > 0, _c(num).cast("double") / _c(den)).otherwise(F.lit(0.0))


def int_div(num, den) -> Column:
    """integer average (truncating), 0 when den is 0."""
    # decimal quotient cast to long truncates toward zero, like Java's long division
    q = _c(num).cast("decimal(38,0)") / _c(den).cast("decimal(38,0)")
    return F.when(_c(den) > 0, q).otherwise(F.lit(0)).cast("long")


def word_tokens(col) -> Column:
    """Lower-cased word tokens of a text, in order (whole text, no cap)."""
    return F.filter(F.split(F.lower(_c(col)), SPLIT_PATTERN), lambda t: t != "")


def last_csv_token(col) -> Column:
    """J6 helper: last comma-separated token after dropping trailing commas."""
    return F.element_at(F.split(F.regexp_replace(_c(col), ",+$", ""), ","), -1)

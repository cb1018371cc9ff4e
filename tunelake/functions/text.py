"""Column-level predicates and casts for dirty chart text.

All of these return built-in Catalyst expressions, so they stay inside
whole-stage codegen and prefix / not-null tests reach the parquet scan as
pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# "Plain non-negative number" pattern, Java regex semantics: ASCII digits,
# optional fraction; no sign, exponent, blanks or trailing dot. Java's `$`
# also accepts one trailing line terminator.
PLAIN_NUMBER_PATTERN = r"^\d+(\.\d+)?$"
# ---------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_plain_number(c: str | Column) -> Column:
    """True when the text is a plain non-negative decimal number."""
    return _c(c).rlike(PLAIN_NUMBER_PATTERN)


def not_plain_number(c: str | Column) -> Column:
    """rejects rows whose key column holds a number (shifted CSV rows)."""
    return ~is_plain_number(c)


def has_prefix(c: str | Column, prefix: str) -> Column:
    """Text prefix test; pushed to parquet as ``StringStartsWith``."""
    return _c(c).startswith(prefix)


def to_count(c: str | Column) -> Column:
    """Text -> double -> long, truncating the fraction.

    ``try_cast`` keeps the reference's (non-ANSI) behaviour on Spark 4: text
    that is not a number becomes null instead of failing the job.
    """
    return _c(c).try_cast("double").try_cast("bigint")


def to_feature(c: str | Column) -> Column:
    """Text -> double; bad text becomes null."""
    return _c(c).try_cast("double")


def all_not_null(cols) -> Column:
    """conjunction of ``IS NOT NULL`` over the given columns."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & _c(c).isNotNull()
    return cond

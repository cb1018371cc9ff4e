"""Display-text helpers used by the serving views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
TIME_OF_DAY_FORMAT = "HH:mm:ss"        # strftime("%H:%M:%S")
EXPORT_DATE_FORMAT = "dd-MM-yyyy"      # strftime('%d-%m-%Y')
UNKNOWN_TRACK = "Unknown Track"        # default for a missing track_id
STREAMS_SUFFIX = " streams"            # f"{streams:,} streams"
# ---------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_of_day(ts: str | Column) -> Column:
    """``HH:mm:ss`` text of a timestamp in the session time zone."""
    return F.date_format(_c(ts), TIME_OF_DAY_FORMAT)


def export_date(d: str | Column) -> Column:
    """``dd-MM-yyyy`` text of a date."""
    return F.date_format(_c(d), EXPORT_DATE_FORMAT)


def thousands(c: str | Column) -> Column:
    """Integer with ``,`` thousands separators (``1,234,567``)."""
    return F.format_number(_c(c), 0)


def streams_label(c: str | Column) -> Column:
    """``"1,234 streams"``."""
    return F.concat(thousands(c), F.lit(STREAMS_SUFFIX))


def two_decimals(c: str | Column) -> Column:
    """Two-decimal text as Python's ``f"{x:.2f}"`` prints it.

    Python rounds the exact binary value (ties of exact halves to even:
    0.125 -> ``0.12``, 2.675 -> ``2.67``). ``format_number`` does the same
    (``DecimalFormat``, HALF_EVEN on the exact value); its grouping commas are
    removed. Java's ``format_string("%.2f")`` would differ on such values
    (``0.13``, ``2.68``): it rounds the shortest decimal text half up.
    Equal to Python for ``|x| < 2**44`` (~1.8e13), where a double's spacing is
    below 0.005; beyond that ``DecimalFormat`` pads the shortest text with
    zeros where Python prints the exact binary value.
    """
    return F.regexp_replace(F.format_number(_c(c), 2), ",", "")


def with_default(c: str | Column, default: str = UNKNOWN_TRACK) -> Column:
    """Value, or a default when the field is missing."""
    return F.coalesce(_c(c), F.lit(default))

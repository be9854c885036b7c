"""Number parsing and small column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number with optional sign and exponent,
# surrounding blanks allowed. Anything else (text, nan, inf, suffixes such as
# "1d") is not a number. A datetime is "Y-M-D H:M" with one- or two-digit month,
# day and hour, and optional seconds and fraction.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATETIME_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"
MAX_DOUBLE = 1.7976931348623157e308


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """DOUBLE for a plain decimal number, else NULL; never fails the job.

    An exponent past the double range gives +-Infinity: test with
    :func:`is_finite` where that matters (one regex and one cast per value).
    """
    c = col_(c)
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def is_finite(c) -> Column:
    """False for NULL, NaN and +-Infinity."""
    return F.coalesce(F.abs(col_(c)) <= F.lit(MAX_DOUBLE), F.lit(False))


def to_datetime(c) -> Column:
    """TIMESTAMP_NTZ for a well-formed value (see ``DATETIME_PATTERN``), else NULL."""
    c = col_(c)
    return F.when(c.rlike(DATETIME_PATTERN), c.try_cast("timestamp_ntz"))


def iso_weekday(ts) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return (F.weekday(col_(ts)) + 1).cast("int")


def rounded(c, digits: int = 6) -> Column:
    return F.round(col_(c), digits)

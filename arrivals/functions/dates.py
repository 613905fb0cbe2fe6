"""Date expressions, all native Catalyst expressions (no Python UDF).

``sas_date`` turns a SAS day number (days since 1960-01-01, stored as a
double) into a date.  The number is truncated toward zero; anything that is
not a finite number inside the range of dates from year 1 to year 9999
gives null instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The SAS epoch and the day numbers of 0001-01-01 and
# 9999-12-31 relative to it, the span a date can take in the output.
SAS_EPOCH = "1960-01-01"
MIN_DAY = -715509
MAX_DAY = 2936549


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sas_date(days: Column | str) -> Column:
    """SAS day number (double) -> DATE, null when not convertible."""
    n = _c(days).try_cast("int")  # truncates toward zero; NaN, inf, overflow -> null
    return F.when(n.between(MIN_DAY, MAX_DAY),
                  F.date_add(F.lit(SAS_EPOCH).cast("date"), n))


def day_number(d: Column | str) -> Column:
    """DATE -> SAS day number as a double (inverse of :func:`sas_date`)."""
    return F.datediff(_c(d).cast("date"), F.lit(SAS_EPOCH).cast("date")).cast("double")


def weekday_sunday_zero(d: Column | str) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday (Spark's own is 1-based)."""
    return F.dayofweek(_c(d)) - 1


def date_parts(d: Column | str) -> dict[str, Column]:
    """The ``date_time`` dimension columns of one date.

    Week is the ISO week; month and weekday are stored as text, as the
    target table declares them VARCHAR.
    """
    d = _c(d)
    return {
        "day": F.dayofmonth(d),
        "week": F.weekofyear(d),
        "month": F.month(d).cast("string"),
        "year": F.year(d),
        "weekday": weekday_sunday_zero(d).cast("string"),
    }

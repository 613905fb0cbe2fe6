"""Predicates the jobs and checks share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_years(df: DataFrame, year_col: str, years: int) -> DataFrame:
    """Keep rows of the last ``years`` years present in the data.

    The same rows as ``year <= max(year) AND year > max(year) - years``.
    The bound is an uncorrelated scalar subquery: Spark runs that one-row
    aggregate once (reading the single column) and uses its value in the
    filter, with no join and no driver round trip.  Idempotent.
    """
    y = F.col(year_col)
    # ``year <= max(year)`` holds for every row with a year, and a null year
    # fails the lower bound too, so the lower bound alone is the window.  As
    # its own subquery value (``max(year) - years``) it reaches the scan as a
    # pushed filter, and row groups of older years can be skipped.
    floor = df.select(F.max(y) - F.lit(years)).scalar()
    return df.filter(y > floor)


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))

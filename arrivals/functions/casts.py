"""Typed casts in the forgiving form: a bad value becomes null.

The raw sources carry doubles where the tables want integers; under ANSI
mode a plain cast of NaN or of an out-of-range value fails the whole job,
so every narrowing cast is a ``try_cast`` and the contract checks count the
nulls it leaves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bigint(c: Column | str) -> Column:
    return _c(c).try_cast("bigint")


def to_int(c: Column | str) -> Column:
    return _c(c).try_cast("int")


def to_float(c: Column | str) -> Column:
    return _c(c).try_cast("float")


def to_date(c: Column | str) -> Column:
    return _c(c).try_cast("date")


def to_str(c: Column | str) -> Column:
    return _c(c).cast("string")

"""Column expressions: SAS day numbers, typed casts, date parts."""

from arrivals.functions.dates import (
    date_parts,
    day_number,
    sas_date,
    weekday_sunday_zero,
)
from arrivals.functions.casts import to_bigint, to_date, to_float, to_int, to_str

__all__ = [
    "date_parts", "day_number", "sas_date", "weekday_sunday_zero",
    "to_bigint", "to_date", "to_float", "to_int", "to_str",
]

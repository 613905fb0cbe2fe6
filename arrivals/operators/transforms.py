"""The table-building jobs, DataFrame in and DataFrame out (no I/O).

Each function is one declarative plan; Catalyst fuses the projections and
casts into one codegen stage and plans a single de-duplicating aggregate
(partial on the map side, final after one shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals import contracts as C
from arrivals.functions import casts as X
from arrivals.functions.dates import date_parts, sas_date
from arrivals.operators.filters import recent_years
from arrivals.sources.raw import RAW_ARRIVALS

ARRIVAL_COLUMNS = [f.name for f in RAW_ARRIVALS.fields]


def fact_arrivals(raw: DataFrame) -> DataFrame:
    """Arrival records -> ``fact_immigration`` rows.

    Takes the raw columns (as many files as were scanned, duplicates
    included), converts the SAS day number natively, types every column
    and keeps each distinct typed row once.  De-duplicating once after
    typing gives the same set as de-duplicating per file, then across
    files, then after typing: the casts are deterministic per row.
    """
    return typed_arrivals(raw).distinct()


def typed_arrivals(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fact's typed columns of each raw record, and the columns ``keep``."""
    return raw.select(
        X.to_bigint("cicid").alias("cic_id"),
        X.to_int("i94cit").alias("born_country"),
        X.to_int("i94res").alias("res_country"),
        X.to_int("i94mode").alias("i94_mode"),
        X.to_str("i94addr").alias("arr_state"),
        X.to_int("i94bir").alias("age"),
        X.to_int("i94visa").alias("i94_visa"),
        X.to_int("biryear").alias("birth_year"),
        X.to_str("gender").alias("gender"),
        X.to_str("visatype").alias("visa_type"),
        sas_date("arrdate").alias("arrival_date"),
        *keep,
    )


# Raw demographics header -> table column, in output order.
DEMOGRAPHICS_RENAME = [
    ("City", "city"),
    ("State Code", "state_code"),
    ("State", "state"),
    ("Median Age", "med_age"),
    ("Male Population", "male_pop"),
    ("Female Population", "female_pop"),
    ("Total Population", "tot_pop"),
    ("Number of Veterans", "num_veterans"),
    ("Foreign-born", "foreign_born"),
    ("Average Household Size", "avg_household"),
    ("Race", "race"),
    ("Count", "count"),
]

DEMOGRAPHICS_TYPES = {
    "city": "string", "state_code": "string", "state": "string", "med_age": "float",
    "male_pop": "bigint", "female_pop": "bigint", "tot_pop": "bigint",
    "num_veterans": "bigint", "foreign_born": "bigint", "avg_household": "float",
    "race": "string", "count": "bigint",
}


def rename(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Select and rename in one projection, in the order given."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in pairs])


def cast_keep_names(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to the given types; each keeps its own name."""
    return df.select(*[_typed(F.col(c), t).alias(c) for c, t in types.items()])


def _typed(c: Column, t: str) -> Column:
    return c.cast(t) if t == "string" else c.try_cast(t)


def city_demographics(raw: DataFrame) -> DataFrame:
    """Raw demographics -> typed, distinct rows with ``state_code`` kept.

    ``state_code`` is a layout column: the sink turns it into folders, the
    warehouse table does not have it.
    """
    return cast_keep_names(rename(raw, DEMOGRAPHICS_RENAME), DEMOGRAPHICS_TYPES).distinct()


def country_readings(raw: DataFrame, country: str = "United States") -> DataFrame:
    """Raw readings -> one country's readings with their month and year.

    The country filter runs before the projection that drops ``Country``,
    so Parquet/CSV readers see it first.  ``partition_state`` is a copy of
    ``state`` used only as folder layout, so the file keeps ``state``.
    """
    return (raw.filter(F.col("Country") == F.lit(country))
            .select(F.col("dt"), F.col("AverageTemperature").alias("avg_temp"),
                    F.col("State").alias("state"))
            .withColumns({"month": F.month("dt"), "year": F.year("dt"),
                          "partition_state": F.col("state")}))


def recent_readings(readings: DataFrame, years: int = 10) -> DataFrame:
    """A country's readings of the last ``years`` years, typed and distinct."""
    return recent_years(readings, "year", years).select(
        X.to_date("dt").alias("dt"),
        X.to_str("state").alias("state"),
        X.to_float("avg_temp").alias("avg_temp"),
        X.to_int("month").alias("month"),
        X.to_int("year").alias("year"),
        X.to_str("partition_state").alias("partition_state"),
    ).distinct()


def state_temperature_staging(raw: DataFrame, years: int = 10,
                              country: str = "United States") -> DataFrame:
    """Raw readings -> one country's readings of the last ``years`` years."""
    return recent_readings(country_readings(raw, country), years)


def country_codes(raw: DataFrame) -> DataFrame:
    """Country codes as delivered, typed to the table contract."""
    return C.COUNTRY_CODE.conform(raw)


def state_temperature_dim(staging: DataFrame, years: int = 10) -> DataFrame:
    """Average temperature per (state, month) over the last ``years`` years.

    The window is the same idempotent filter the staging job applies, so
    running it again on staged rows changes nothing.  The average is taken
    in double and stored as float.
    """
    recent = recent_years(staging, "year", years)
    return (recent.groupBy("state", "month")
            .agg(F.avg("avg_temp").cast("float").alias("avg_temperature")))


def date_dim(fact: DataFrame) -> DataFrame:
    """One row per distinct arrival date with its calendar parts.

    Only the date column is read; each task reduces its rows to the few
    distinct dates it saw before the shuffle.  A null date has no calendar
    row (the target key is NOT NULL).
    """
    d = (fact.select(F.col("arrival_date").alias("date"))
         .filter(F.col("date").isNotNull()).distinct())
    return d.select("date", *[v.alias(k) for k, v in date_parts(F.col("date")).items()])

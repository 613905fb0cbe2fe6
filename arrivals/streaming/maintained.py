"""Aggregates kept up by each run instead of scanning the history.

Two small tables lie in year/month folders beside the data they sum up:
arrivals per (state, year, month) of the fact, and the sum and number of
readings per (state, year, month).  A run recounts exactly the months it
touched, from their folders, and exchanges these months' folders, so a
replayed run, a correction or a backfill leaves the right numbers.  The
analyses and the temperature dimension are computed from these tables, whose
size is bounded by states and months; old years leave the window unread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.functions import casts as X
from arrivals.operators.filters import recent_years
from arrivals.operators.transforms import country_readings
from arrivals.session import delete_path, path_exists, scratch_dir
from arrivals.sinks import months as M
from arrivals.sinks.parquet import write_partitioned
from arrivals.streaming.daily import STORED_SCHEMA


def _schema(**columns: T.DataType) -> T.StructType:
    layout = {c: T.IntegerType() for c in M.LAYOUT}
    return T.StructType([T.StructField(c, kind) for c, kind in {**columns, **layout}.items()])


COUNTS_SCHEMA = _schema(arr_state=T.StringType(), arrivals=T.LongType())
READINGS_SCHEMA = _schema(dt=T.DateType(), state=T.StringType(), avg_temp=T.FloatType())
SUMS_SCHEMA = _schema(state=T.StringType(), total=T.DoubleType(), n=T.LongType())


def _months_of(df: DataFrame) -> list[M.Month]:
    """The months of some rows: bounded by the calendar."""
    return [(r["year"], r["month"]) for r in df.select(*M.LAYOUT).distinct().collect()]


# ---- arrivals per state and month ---------------------------------------------

def refresh_travel_counts(spark: SparkSession, fact_path: str, counts_path: str, months: list[M.Month]) -> None:
    """Recount the arrivals of ``months`` (such as a daily run's touched ones);
    of the fact only the state column of these months is read."""
    stored = M.read_months(spark, fact_path, STORED_SCHEMA, months)
    counts = stored.groupBy("arr_state", *M.LAYOUT).agg(F.count(F.lit(1)).alias("arrivals"))
    M.replace_months(spark, counts.select("arr_state", "arrivals", *M.LAYOUT), counts_path, months, ["arr_state"])


def travel_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    M.complete(spark, counts_path)
    return spark.read.schema(COUNTS_SCHEMA).parquet(counts_path)


# ---- readings per state and month ----------------------------------------------

def merge_readings(spark: SparkSession, raw: DataFrame, readings_path: str, sums_path: str,
                   country: str = "United States") -> list[M.Month]:
    """Add a delivery of raw readings: readings that are not stored yet are
    appended, and the touched months summed up anew.  Returns these months."""
    kept = scratch_dir(spark, "readings-delivery")
    (country_readings(raw, country).select(
        X.to_date("dt").alias("dt"), X.to_str("state").alias("state"), X.to_float("avg_temp").alias("avg_temp"),
        X.to_int("year").alias("year"), X.to_int("month").alias("month")).distinct().write.parquet(kept))
    new = spark.read.schema(READINGS_SCHEMA).parquet(kept)
    months = _months_of(new)
    old = M.read_months(spark, readings_path, READINGS_SCHEMA, months)
    same = reduce(lambda a, b: a & b, [new[c].eqNullSafe(old[c]) for c in READINGS_SCHEMA.names])
    write_partitioned(new.join(old, same, "left_anti"), readings_path, M.LAYOUT, mode="append")
    stored = M.read_months(spark, readings_path, READINGS_SCHEMA, months)
    sums = stored.groupBy("state", *M.LAYOUT).agg(F.sum(F.col("avg_temp").cast("double")).alias("total"),
                                                  F.count("avg_temp").alias("n"))
    M.replace_months(spark, sums.select("state", "total", "n", *M.LAYOUT), sums_path, months, ["state"])
    delete_path(spark, kept)
    return months


def state_temperature_of_sums(spark: SparkSession, sums_path: str, years: int = 10) -> DataFrame:
    """The temperature dimension from the stored sums: the same window of the
    last ``years`` years and the same means as from all readings."""
    M.complete(spark, sums_path)
    if not path_exists(spark, sums_path):
        sums = spark.createDataFrame([], SUMS_SCHEMA)
    else:
        sums = spark.read.schema(SUMS_SCHEMA).parquet(sums_path)
    return (recent_years(sums, "year", years).groupBy("state", "month")
            .agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).cast("float").alias("avg_temperature")))

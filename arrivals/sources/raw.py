"""Schemas of the raw inputs, as the sources deliver them."""

from __future__ import annotations

from pyspark.sql import types as T

D, S, L, Dt = T.DoubleType(), T.StringType(), T.LongType(), T.DateType()

# Arrival records: SAS numerics arrive as doubles, dates as SAS day numbers.
RAW_ARRIVALS = T.StructType([
    T.StructField("cicid", D, False),
    T.StructField("i94cit", D),
    T.StructField("i94res", D),
    T.StructField("arrdate", D),
    T.StructField("i94mode", D),
    T.StructField("i94addr", S),
    T.StructField("i94bir", D),
    T.StructField("i94visa", D),
    T.StructField("biryear", D),
    T.StructField("gender", S),
    T.StructField("visatype", S),
])

# City demographics: ';'-separated CSV whose header names contain blanks.
RAW_DEMOGRAPHICS = T.StructType([
    T.StructField("City", S),
    T.StructField("State", S),
    T.StructField("Median Age", D),
    T.StructField("Male Population", L),
    T.StructField("Female Population", L),
    T.StructField("Total Population", L),
    T.StructField("Number of Veterans", L),
    T.StructField("Foreign-born", L),
    T.StructField("Average Household Size", D),
    T.StructField("State Code", S),
    T.StructField("Race", S),
    T.StructField("Count", L),
])

# Land temperature by state: ','-separated CSV.
RAW_TEMPERATURE = T.StructType([
    T.StructField("dt", Dt),
    T.StructField("AverageTemperature", D),
    T.StructField("AverageTemperatureUncertainty", D),
    T.StructField("State", S),
    T.StructField("Country", S),
])

# Country codes: ','-separated CSV, names kept as written (leading blank).
RAW_COUNTRY_CODES = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("country", S),
])

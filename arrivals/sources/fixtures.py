"""The driver's tables reshaped into the raw source shapes.

The raw inputs of this pipeline (arrival records, city demographics, state
temperatures, country codes) are not shipped, so checks and benchmarks
derive frames of the same shape from the driver's TPC-H-like tables.  Every
mapping is deterministic and whole-table, so DuckDB can build the same
relations (``arrivals.plans.oracle``) and the work grows with the tables.

Mappings (see FIXTURES.md):

* arrivals     = orders join customer (one record per order)
* demographics = customer join nation (one row per customer: city is the
  nation, state the market segment, race a bucket of the customer key)
* temperature  = lineitem join orders join customer (one reading per line)
* country codes = customer (code = customer key, name = customer name)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.functions.dates import day_number, sas_date
from arrivals.sinks.parquet import write_partitioned


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _state_code(segment):
    return F.upper(F.substring(segment, 1, 2))


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival records in the raw SAS shape (all numbers doubles).

    ``arrdate`` carries half a day on top of the day number so that the
    date conversion's truncation is exercised on every row.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    age = 20 + F.col("o_custkey") % 60
    return j.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.col("c_nationkey").cast("double").alias("i94res"),
        (day_number("o_orderdate") + F.lit(0.5)).alias("arrdate"),
        (1 + F.col("o_orderkey") % 3).cast("double").alias("i94mode"),
        _state_code(F.col("c_mktsegment")).alias("i94addr"),
        age.cast("double").alias("i94bir"),
        (1 + F.col("o_custkey") % 3).cast("double").alias("i94visa"),
        (F.year("o_orderdate") - age).cast("double").alias("biryear"),
        F.col("o_orderstatus").alias("gender"),
        F.substring("o_orderpriority", 1, 1).alias("visatype"),
    )


def raw_arrivals_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival records with faults a check must find, by the order key.

    Missing ids and dates, ages beyond an integer, codes over their length,
    and records delivered twice with ids that differ only in a fraction, so
    that they merge when typed.
    """
    raw = raw_arrivals(spark, sf_dir)
    k = F.col("cicid").cast("bigint")
    faulty = raw.withColumns({
        "i94addr": F.when(k % 40 == 7, F.lit("LONGX")).otherwise(F.col("i94addr")),
        "visatype": F.when(k % 45 == 13, F.lit("LONG")).otherwise(F.col("visatype")),
        "i94bir": F.when(k % 7 == 2, F.lit(1e20)).otherwise(F.col("i94bir")),
        "biryear": F.when(k % 9 == 4, F.lit(float("nan"))).otherwise(F.col("biryear")),
        "arrdate": F.when(k % 60 == 11, F.lit(None).cast("double")).otherwise(F.col("arrdate")),
        "cicid": F.when(k % 50 == 3, F.lit(None).cast("double")).otherwise(F.col("cicid")),
    })
    again = faulty.filter(F.col("cicid").cast("bigint") % 30 == 5)
    return faulty.unionByName(again.withColumn("cicid", F.col("cicid") + 0.25))


def raw_temperature_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose values are missing for some states in every February."""
    gone = (F.month("dt") == 2) & F.col("State").startswith("A")
    value = F.when(gone, F.lit(None).cast("double")).otherwise(F.col("AverageTemperature"))
    return raw_temperature(spark, sf_dir).withColumn("AverageTemperature", value)


def country_codes_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country codes, some of them twice."""
    cc = raw_country_codes_of_customers(spark, sf_dir)
    return cc.unionByName(cc.filter(F.col("code") % 25 == 1))


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City demographics in the raw CSV shape (header names with blanks).

    City-level measures depend only on (nation, segment), so they repeat
    across the race rows of a city as in the real file.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("n_nationkey") + 1
    seg_len = F.length("c_mktsegment")
    return j.select(
        F.col("n_name").alias("City"),
        F.col("c_mktsegment").alias("State"),
        (F.col("n_nationkey") + F.lit(30.5)).cast("double").alias("Median Age"),
        (400 * k + 20 * seg_len).cast("bigint").alias("Male Population"),
        (600 * k + 30 * seg_len).cast("bigint").alias("Female Population"),
        (1000 * k + 50 * seg_len).cast("bigint").alias("Total Population"),
        (10 * k).cast("bigint").alias("Number of Veterans"),
        (30 * k).cast("bigint").alias("Foreign-born"),
        (F.lit(2.0) + (F.col("n_nationkey") % 4) * F.lit(0.25)).alias("Average Household Size"),
        _state_code(F.col("c_mktsegment")).alias("State Code"),
        F.concat(F.lit("R"), (F.col("c_custkey") % 5).cast("string")).alias("Race"),
        F.col("c_custkey").cast("bigint").alias("Count"),
    )


def raw_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State temperature readings in the raw CSV shape.

    Orders with status 'P' are booked to another country, so the
    country filter has rows to drop.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    return j.select(
        F.col("o_orderdate").cast("date").alias("dt"),
        F.col("l_quantity").alias("AverageTemperature"),
        F.col("l_discount").alias("AverageTemperatureUncertainty"),
        F.col("c_mktsegment").alias("State"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Canada"))
         .otherwise(F.lit("United States")).alias("Country"),
    )


def raw_country_codes_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country codes, one per customer key, so the table grows with the data.

    Names keep a leading blank, as most names in the shipped code file do.
    """
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("int").alias("code"),
                    F.concat(F.lit(" "), F.col("c_name")).alias("country"))


def write_raw_inputs(spark: SparkSession, sf_dir: str, root: str,
                     repeat_arrivals: bool = True) -> dict[str, str]:
    """Write the four raw inputs as files below ``root``; return their paths.

    Arrivals go out as one Parquet folder per arrival month, the way
    monthly deliveries land; with ``repeat_arrivals`` the whole delivery is
    written a second time under another folder, so every record is present
    in two files and the fact job's de-duplication is exercised.
    Demographics are ';'-CSV, temperature and country codes ','-CSV.
    """
    root = root.rstrip("/")
    arr = raw_arrivals(spark, sf_dir)
    # Each delivery month's records land in files of that month only.
    layout = arr.withColumn("delivery", F.date_format(sas_date("arrdate"), "yyyy-MM"))
    for b in (1, 2) if repeat_arrivals else (1,):
        write_partitioned(layout, f"{root}/arrivals/batch={b}", ["delivery"])
    (raw_demographics(spark, sf_dir).write.mode("overwrite")
     .option("header", "true").option("sep", ";").csv(f"{root}/demographics"))
    (raw_temperature(spark, sf_dir).write.mode("overwrite")
     .option("header", "true").csv(f"{root}/temperature"))
    (raw_country_codes_of_customers(spark, sf_dir).write.mode("overwrite")
     .option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .csv(f"{root}/country_code"))
    return {
        "arrivals": f"{root}/arrivals",
        "demographics": f"{root}/demographics",
        "temperature": f"{root}/temperature",
        "country_code": f"{root}/country_code",
    }

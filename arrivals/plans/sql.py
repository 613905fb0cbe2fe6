"""The two dimension queries as Spark SQL text.

Same results as :func:`arrivals.operators.transforms.state_temperature_dim`
and :func:`~arrivals.operators.transforms.date_dim`, for loads driven by SQL
templates (``Warehouse.insert_select``).  The source table is bound through
``IDENTIFIER(:src)`` and the window length through ``:years``, never by
string formatting.  The window is the lower bound alone (every year is at
most the latest one), as one subquery value the Parquet scan can push down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATE_TEMPERATURE_SELECT = """
SELECT state, month, CAST(AVG(avg_temp) AS FLOAT) AS avg_temperature
FROM IDENTIFIER(:src)
WHERE year > (SELECT MAX(year) - :years FROM IDENTIFIER(:src))
GROUP BY state, month
"""

DATE_TIME_SELECT = """
SELECT DISTINCT arrival_date AS `date`,
       dayofmonth(arrival_date) AS `day`,
       weekofyear(arrival_date) AS `week`,
       CAST(month(arrival_date) AS STRING) AS `month`,
       year(arrival_date) AS `year`,
       CAST(dayofweek(arrival_date) - 1 AS STRING) AS `weekday`
FROM IDENTIFIER(:src)
WHERE arrival_date IS NOT NULL
"""


def state_temperature_sql(spark: SparkSession, staging_table: str, years: int = 10) -> DataFrame:
    return spark.sql(STATE_TEMPERATURE_SELECT, args={"src": staging_table, "years": years})


def date_time_sql(spark: SparkSession, fact_table: str) -> DataFrame:
    return spark.sql(DATE_TIME_SELECT, args={"src": fact_table})

"""The three questions on hand-made rows: ordering, de-duplication, null-safe correlation."""

import datetime as dt
import math

from pyspark.sql import functions as F

from arrivals.operators import analytics as A

FACT = "cic_id bigint, arr_state string, arrival_date date"


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_travel_by_state_month_counts_and_orders(spark):
    d1, d2 = dt.date(2016, 4, 1), dt.date(2016, 5, 3)
    fact = _fact(spark, [(1, "NY", d1), (2, "NY", d1), (3, "CA", d1), (4, "NY", d2)])
    got = [tuple(r) for r in A.travel_by_state_month(fact).collect()]
    assert got == [("NY", 2016, 4, 2), ("CA", 2016, 4, 1), ("NY", 2016, 5, 1)]


def test_safe_corr_is_null_on_a_constant_series(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert df.agg(A.safe_corr("a", "b").alias("r")).first().r is None


def test_safe_corr_equals_corr(spark):
    rows = [(float(i), float(i * i % 7) + 0.5 * i) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double")
    r = df.agg(A.safe_corr("a", "b").alias("r"), F.corr("a", "b").alias("c")).first()
    assert math.isclose(r.r, r.c, rel_tol=1e-12)


def test_demographics_count_a_city_once_across_race_rows(spark):
    d = dt.date(2016, 4, 1)
    # NY: 3 arrivals, CA: 1, TX: 2.  Populations: NY 100 (two race rows of
    # one city), CA 300 (two cities), TX 200.
    fact = _fact(spark, [(1, "NY", d), (2, "NY", d), (3, "NY", d), (4, "CA", d),
                         (5, "TX", d), (6, "TX", d)])
    dem = spark.createDataFrame(
        [("A", "NY", 100, "R1"), ("A", "NY", 100, "R2"), ("B", "CA", 100, "R1"),
         ("C", "CA", 200, "R1"), ("D", "TX", 200, "R3")],
        "city string, state_code string, tot_pop bigint, race string")
    got = A.corr_travel_demographics(fact, dem).first().r
    n, pop = [3.0, 1.0, 2.0], [100.0, 300.0, 200.0]
    mn, mp = sum(n) / 3, sum(pop) / 3
    cov = sum((a - mn) * (b - mp) for a, b in zip(n, pop))
    want = cov / math.sqrt(sum((a - mn) ** 2 for a in n) * sum((b - mp) ** 2 for b in pop))
    assert got == round(want, 6)


def test_temperature_join_goes_through_the_state_bridge(spark):
    fact = _fact(spark, [(1, "NY", dt.date(2016, 1, 5)), (2, "NY", dt.date(2016, 7, 5)),
                         (3, "NY", dt.date(2016, 7, 6)), (4, "ZZ", dt.date(2016, 7, 6))])
    city = spark.createDataFrame([("NY", "New York"), ("NY", "New York")],
                                 "state_code string, state string")
    temp = spark.createDataFrame([("New York", 1, -2.0), ("New York", 7, 25.0)],
                                 "state string, month int, avg_temperature float")
    # Two (state, month) points, (1 arrival, -2.0) and (2 arrivals, 25.0): r = 1.
    assert A.corr_travel_temperature(fact, A.state_bridge(city), temp).first().r == 1.0
    # One point only: a constant series, so null rather than an error.
    one = temp.filter("month = 7")
    assert A.corr_travel_temperature(fact, A.state_bridge(city), one).first().r is None

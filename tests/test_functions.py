import datetime as dt
import math

from pyspark.sql import functions as F

from arrivals.functions import dates, casts


def _one(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def python_reference(x):
    """What a per-row conversion with Python dates gives (null when it cannot)."""
    try:
        return (dt.datetime(1960, 1, 1) + dt.timedelta(days=int(x))).date()
    except Exception:  # noqa: BLE001
        return None


def test_sas_date_edges(spark):
    vals = [None, float("nan"), float("inf"), float("-inf"), -0.9, -1.5, 0.0, 20545.7,
            2936549.0, 2936550.0, -715509.0, -715510.0, 1e12, -1e12, 0.5]
    got = _one(spark, vals, dates.sas_date)
    want = [None if v is None else python_reference(v) for v in vals]
    assert got == want
    assert got[vals.index(20545.7)] == dt.date(2016, 4, 1)
    assert got[vals.index(-1.5)] == dt.date(1959, 12, 31)  # truncation toward zero
    assert got[vals.index(-0.9)] == dt.date(1960, 1, 1)


def test_day_number_round_trip(spark):
    df = spark.createDataFrame([(dt.date(1995, 3, 7),), (dt.date(1950, 1, 1),)], "d date")
    out = df.select(dates.sas_date(dates.day_number("d") + F.lit(0.5)).alias("d2"), "d").collect()
    assert all(r.d == r.d2 for r in out if r.d >= dt.date(1960, 1, 1))


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),), (dt.date(2016, 4, 3),)], "d date")
    rows = df.select(*[v.alias(k) for k, v in dates.date_parts("d").items()]).collect()
    assert rows[0].week == 53 and rows[0].day == 1 and rows[0].month == "1"
    assert rows[0].weekday == "5"  # Friday, 0 = Sunday
    assert rows[1].weekday == "0"  # Sunday
    assert rows[1].year == 2016


def test_casts_forgiving(spark):
    vals = [None, float("nan"), float("inf"), 1e12, 3.9, -3.9]
    assert _one(spark, vals, casts.to_int) == [None, None, None, None, 3, -3]
    assert _one(spark, vals, casts.to_bigint) == [None, None, None, 1000000000000, 3, -3]
    f = _one(spark, vals, casts.to_float)
    assert f[0] is None and math.isnan(f[1]) and math.isinf(f[2])
    assert _one(spark, ["2016-04-01", "nope"], casts.to_date, "string") == [dt.date(2016, 4, 1), None]


def test_cluster_session_without_checkpoint_dir_is_refused():
    import pytest
    from arrivals.session import shared_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "spark://cluster:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class RuntimeConf:
        def get(self, key):
            raise KeyError(key)

    class Session:
        sparkContext = Ctx()
        conf = RuntimeConf()

    with pytest.raises(RuntimeError, match="shared storage"):
        shared_root(Session())

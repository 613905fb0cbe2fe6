"""Property tests: native date conversion vs Python dates; file order; daily runs."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from arrivals.functions import dates
from arrivals.operators import transforms as J
from arrivals.plans import pipeline as P
from arrivals.sources import raw as R


def expected_date(x):
    """Day 0 is 1960-01-01; a fraction is cut; outside years 1 to 9999: no date."""
    if not math.isfinite(x):
        return None
    ordinal = dt.date(1960, 1, 1).toordinal() + math.trunc(x)
    return dt.date.fromordinal(ordinal) if 1 <= ordinal <= dt.date.max.toordinal() else None


doubles = st.one_of(
    st.floats(allow_nan=True, allow_infinity=True),
    st.floats(min_value=-800000, max_value=3000000),
    st.integers(min_value=-715515, max_value=-715500).map(float),
    st.integers(min_value=2936540, max_value=2936560).map(float),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(doubles, min_size=1, max_size=200))
def test_sas_date_matches_python_dates(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(dates.sas_date("x")).collect()]
    assert got == [expected_date(v) for v in values]


def _arr(i):
    return (float(i), 1.0, 1.0, 20000.0 + i, 1.0, "NY", 30.0, 2.0, 1986.0, "M", "B1")


def test_file_order_does_not_matter(spark, tmp_root):
    a = spark.createDataFrame([_arr(i) for i in range(0, 20)], R.RAW_ARRIVALS)
    b = spark.createDataFrame([_arr(i) for i in range(10, 30)], R.RAW_ARRIVALS)
    a.write.parquet(f"{tmp_root}/one/a")
    b.write.parquet(f"{tmp_root}/one/b")
    b.write.parquet(f"{tmp_root}/two/a")
    a.write.parquet(f"{tmp_root}/two/b")

    def fact(root):
        df = J.fact_arrivals(P.read_arrivals(spark, P.Inputs(root, "", "", "")))
        return sorted(tuple(r) for r in df.collect())

    assert fact(f"{tmp_root}/one") == fact(f"{tmp_root}/two")
    assert len(fact(f"{tmp_root}/one")) == 30


def _delivery_rows(i):
    """Rows of delivery ``i``: ids, months and null dates overlap across deliveries."""
    rows = []
    for j in range(5):
        cid = float("nan") if (i * j) % 11 == 5 else float((i * 3 + j) % 10)
        day = float("nan") if (i + j) % 7 == 0 else 20454.0 + ((i + j) % 3) * 31
        rows.append((cid, 1.0, 1.0, day, 1.0, "NY", 30.0, 2.0, 1986.0, "MF"[j % 2], "B1"))
    return rows


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2), min_size=6, max_size=6),
       st.lists(st.booleans(), min_size=6, max_size=6))
def test_daily_runs_in_any_split_equal_the_batch_fact(spark, run_of, resend):
    """Deliveries spread over up to three daily runs, some re-sent in a later
    run, give the same fact as the batch job over all files."""
    from arrivals.session import scratch_dir
    from arrivals.streaming import daily as D
    root = scratch_dir(spark, "prop-daily")
    src, fact, ckpt = f"{root}/in", f"{root}/fact", f"{root}/ckpt"
    for run in range(3):
        for i, r in enumerate(run_of):
            if r == run or (resend[i] and r < run == 2):
                rows = spark.createDataFrame(_delivery_rows(i), R.RAW_ARRIVALS)
                rows.write.parquet(f"{src}/run={run}/d={i}")
        D.ingest_deliveries(spark, src, fact, ckpt)
    from arrivals.contracts import FACT_ARRIVALS
    got = spark.read.parquet(fact).select(*FACT_ARRIVALS.names)
    want = J.fact_arrivals(P.read_arrivals(spark, P.Inputs(src, "", "", "")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)

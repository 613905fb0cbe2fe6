import datetime as dt

import pytest
from pyspark.sql import functions as F

from arrivals.contracts import FACT_ARRIVALS
from arrivals.operators import transforms as J
from arrivals.operators import filters
from arrivals.plans import pipeline as P
from arrivals.sources import files as S
from arrivals.sources import raw as R


def arrival(cicid, arrdate=20545.7, addr="NY", cit=101.0):
    return (cicid, cit, cit, arrdate, 1.0, addr, 30.0, 2.0, 1986.0, "F", "B2")


def test_fact_dedupes_within_and_across_files(spark, tmp_root):
    rows = [arrival(1.0), arrival(1.0), arrival(2.0)]
    a = spark.createDataFrame(rows, R.RAW_ARRIVALS)
    b = spark.createDataFrame([arrival(2.0), arrival(3.0)], R.RAW_ARRIVALS)
    a.write.parquet(f"{tmp_root}/in/x/a")
    b.write.parquet(f"{tmp_root}/in/y/b")
    fact = J.fact_arrivals(P.read_arrivals(spark, P.Inputs(f"{tmp_root}/in", "", "", "")))
    assert sorted(r.cic_id for r in fact.collect()) == [1, 2, 3]
    assert fact.schema.names == FACT_ARRIVALS.names


def test_rows_equal_after_typing_merge(spark):
    rows = [arrival(1.0, 20545.2), arrival(1.0, 20545.7), arrival(1.25, 20545.7)]
    fact = J.fact_arrivals(spark.createDataFrame(rows, R.RAW_ARRIVALS))
    assert fact.count() == 1
    assert fact.first().arrival_date == dt.date(2016, 4, 1)


def test_missing_input_is_an_error(spark, tmp_root):
    good, gone = f"{tmp_root}/good", f"{tmp_root}/missing"
    spark.createDataFrame([arrival(1.0), arrival(2.0)], R.RAW_ARRIVALS).write.parquet(good)
    for root, glob in ((gone, "*.parquet"), ([good, gone], "*.parquet"), ([], None), (good, "*.sas")):
        with pytest.raises(Exception):
            S.scan_files(spark, root, "parquet", glob, schema=R.RAW_ARRIVALS)
    with pytest.raises(Exception):
        S.scan_files(spark, [good, gone], "parquet", schema=R.RAW_ARRIVALS, allow_empty=True)


def test_empty_typed_fact_where_that_is_allowed(spark, tmp_root):
    raw = S.scan_files(spark, f"{tmp_root}/missing", "parquet", "*.parquet", schema=R.RAW_ARRIVALS, allow_empty=True)
    fact = J.fact_arrivals(raw)
    assert fact.count() == 0
    assert [f.dataType for f in fact.schema.fields] == [c.dtype for c in FACT_ARRIVALS.columns]


def test_arrivals_from_csv_deliveries(spark, tmp_root):
    df = spark.createDataFrame([arrival(1.0), arrival(2.0), arrival(2.0)], R.RAW_ARRIVALS)
    df.write.option("header", "true").csv(f"{tmp_root}/csv/d1")
    inp = P.Inputs(f"{tmp_root}/csv", "", "", "", arrivals_format="csv", arrivals_glob="*.csv",
                   arrivals_options={"header": "true", "inferSchema": "true"})
    got = J.fact_arrivals(P.read_arrivals(spark, inp))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, J.fact_arrivals(df).collect()))


def test_glob_filter_skips_other_files(spark, tmp_root):
    spark.createDataFrame([arrival(1.0)], R.RAW_ARRIVALS).write.parquet(f"{tmp_root}/g/p")
    spark.createDataFrame([("junk",)], "x string").write.json(f"{tmp_root}/g/j")
    raw = S.scan_files(spark, f"{tmp_root}/g", "parquet", "*.parquet", schema=R.RAW_ARRIVALS)
    assert raw.count() == 1


def test_bad_numbers_become_null(spark):
    rows = [(5.0, float("nan"), 1e12, float("inf"), None, "TOOLONG", None, None, None, None, None)]
    fact = J.fact_arrivals(spark.createDataFrame(rows, R.RAW_ARRIVALS)).first()
    assert fact.born_country is None and fact.res_country is None and fact.arrival_date is None
    assert fact.arr_state == "TOOLONG"  # kept; the length check reports it


def test_state_temperature_window_and_country(spark):
    rows = []
    for year in range(2000, 2014):
        rows.append((dt.date(year, 5, 1), 10.0 + year % 3, None, "Texas", "United States"))
        rows.append((dt.date(year, 5, 1), 99.0, None, "Ontario", "Canada"))
    raw = spark.createDataFrame(rows, R.RAW_TEMPERATURE)
    st = J.state_temperature_staging(raw, years=10)
    years = sorted(r.year for r in st.collect())
    assert years == list(range(2004, 2014))
    assert {r.partition_state for r in st.collect()} == {"Texas"}
    # The window is idempotent: applying it again keeps every row.
    assert filters.recent_years(st, "year", 10).count() == st.count()
    dim = J.state_temperature_dim(st, 10).collect()
    assert len(dim) == 1 and dim[0].month == 5
    expected = sum(10.0 + y % 3 for y in range(2004, 2014)) / 10
    assert abs(dim[0].avg_temperature - expected) < 1e-5


def test_country_codes_keep_leading_blank_and_quoted_commas(spark, tmp_root):
    path = f"{tmp_root}/cc.csv"
    import os
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(path.replace("file:", "") + "/part.csv", "w", newline="") as fh:
        fh.write('code,country\r\n903,"NORTH ISLES, upper and lower (one, or both)"\r\n'
                 '17, WESTMARK\r\n5, EASTMARK\r\n')
    cc = J.country_codes(S.read_csv(spark, path, R.RAW_COUNTRY_CODES)).orderBy("code").collect()
    assert [r.code for r in cc] == [5, 17, 903]
    assert cc[0].country == " EASTMARK"
    assert cc[2].country == "NORTH ISLES, upper and lower (one, or both)"
    swapped = f"{tmp_root}/swapped.csv"
    os.makedirs(swapped.replace("file:", ""), exist_ok=True)
    with open(swapped.replace("file:", "") + "/part.csv", "w", newline="") as fh:
        fh.write("country,code\nEASTMARK,5\n")
    with pytest.raises(Exception, match="(?i)header"):
        S.read_csv(spark, swapped, R.RAW_COUNTRY_CODES).collect()


def test_city_demographics_typed_and_distinct(spark):
    row = ("Austin", "Texas", 32.5, 400, 500, 900, 10, 20, 2.5, "TX", "Asian", 77)
    raw = spark.createDataFrame([row, row], R.RAW_DEMOGRAPHICS)
    out = J.city_demographics(raw).collect()
    assert len(out) == 1 and out[0].state_code == "TX" and out[0]["count"] == 77


def test_date_dim_skips_null_date(spark):
    fact = spark.createDataFrame([(dt.date(2016, 4, 1),), (None,), (dt.date(2016, 4, 1),)],
                                 "arrival_date date")
    assert J.date_dim(fact).count() == 1


def test_single_file_scan(spark, tmp_root):
    spark.createDataFrame([arrival(1.0), arrival(2.0)], R.RAW_ARRIVALS).coalesce(1).write.parquet(
        f"{tmp_root}/single")
    import glob
    f = glob.glob(f"{tmp_root.replace('file:', '')}/single/*.parquet")[0]
    assert S.scan_files(spark, f, "parquet", schema=R.RAW_ARRIVALS).count() == 2

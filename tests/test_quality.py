import datetime as dt

import pytest

from arrivals import contracts as C
from arrivals.operators import quality as Q


def _fact(spark, rows):
    return spark.createDataFrame(rows, C.FACT_ARRIVALS.schema.json() and
                                 ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in C.FACT_ARRIVALS.columns))


GOOD = (1, 1, 1, 1, "NY", 30, 2, 1986, "F", "B2", dt.date(2016, 4, 1))


def test_clean_tables_pass(spark):
    fact = _fact(spark, [GOOD, (2,) + GOOD[1:]])
    st = spark.createDataFrame([("Texas", 5, 20.0)], "state string, month int, avg_temperature float")
    cc = spark.createDataFrame([(1, " A"), (2, " B")], "code int, country string")
    rows = Q.assert_passed(Q.report(Q.reference_checks(fact, st, cc)))
    assert [r["passed"] for r in rows] == [True, True, True]


@pytest.mark.parametrize("defect", ["null_id", "null_avg", "dup_code"])
def test_each_reference_check_fails_on_its_defect(spark, defect):
    fact_rows = [GOOD] + ([(None,) + GOOD[1:]] if defect == "null_id" else [])
    st_rows = [("Texas", 5, None if defect == "null_avg" else 20.0)]
    cc_rows = [(1, " A")] + ([(1, " A")] if defect == "dup_code" else [(2, " B")])
    fact = _fact(spark, fact_rows)
    st = spark.createDataFrame(st_rows, "state string, month int, avg_temperature float")
    cc = spark.createDataFrame(cc_rows, "code int, country string")
    rep = Q.report(Q.reference_checks(fact, st, cc))
    failed = {r.check_name for r in rep.collect() if not r.passed}
    assert len(failed) == 1
    with pytest.raises(Q.DataQualityError):
        Q.assert_passed(rep, log=lambda *_: None)


def test_duplicate_count_ignores_null_codes(spark):
    cc = spark.createDataFrame([(None, "X"), (None, "X"), (3, "Y")], "code int, country string")
    assert Q.duplicate_groups(cc, ["code", "country"], counted="code").count() == 0
    assert Q.duplicate_groups(cc, ["code", "country"]).count() == 1


def test_contract_checks_find_seeded_defects(spark):
    bad = [GOOD, GOOD, (None, 1, 1, 1, "NYCX", 30, 2, 1986, "FM", "B2", None)]
    fact = _fact(spark, bad)
    nn = Q.not_null_counts(fact, C.FACT_ARRIVALS).first()
    assert nn.cic_id_nulls == 1 and nn.arrival_date_nulls == 1
    tl = Q.too_long_counts(fact, C.FACT_ARRIVALS).first()
    assert tl.arr_state_too_long == 1 and tl.gender_too_long == 1 and tl.visa_type_too_long == 0
    dups = Q.key_duplicates(fact, C.FACT_ARRIVALS).collect()
    assert [(r.cic_id, r.n) for r in dups] == [(1, 2)]
    rep = Q.contract_report(fact, C.FACT_ARRIVALS).collect()
    assert len(rep) == 2 + 3 + 1
    assert {r.check_name for r in rep if not r.passed} == {
        "fact_immigration.cic_id_not_null", "fact_immigration.arrival_date_not_null",
        "fact_immigration.arr_state_max_length", "fact_immigration.gender_max_length",
        "fact_immigration.key_unique"}


def test_schema_problems(spark):
    df = spark.createDataFrame([(1, "x")], "code bigint, country string")
    assert Q.schema_problems(df, C.COUNTRY_CODE) == ["code: bigint != int"]
    assert Q.schema_problems(C.COUNTRY_CODE.conform(df), C.COUNTRY_CODE) == []
    swapped = df.select("country", "code")
    assert Q.schema_problems(swapped, C.COUNTRY_CODE)


def test_ddl_from_contract():
    ddl = C.FACT_ARRIVALS.ddl("db.fact_immigration")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS db.fact_immigration")
    assert "`arr_state` VARCHAR(3)" in ddl and "`cic_id` BIGINT" in ddl and "USING parquet" in ddl


def test_contract_report_scans_table_once_for_column_checks(spark):
    fact = _fact(spark, [GOOD])
    plan = Q.contract_report(fact, C.FACT_ARRIVALS)._jdf.queryExecution().optimizedPlan().toString()
    # one scan for the column checks, one for the key check
    assert plan.count("LocalRelation") <= 2
    assert all(r.passed for r in Q.contract_report(fact, C.FACT_ARRIVALS).collect())


@pytest.mark.parametrize("sql, expected, passed", [
    ("select true", True, True), ("select true", "true", True), ("select false", True, False),
    ("select 0.00", 0, True), ("select 0", 0.0, True), ("select 0", "0.0", True), ("select 1", 0, False),
    ("select x from values (1), (9) t(x) order by x", 9, False),
    ("select x from values (9), (1) t(x) order by x desc", 9, True),
    ("select 'abc'", "abc", True), ("select 'abc'", "abd", False), ("select cast(null as int)", 0, False),
    ("select 1 where false", 1, False), ("select 1 where false", "", True), ("select cast('nan' as double)", 0, False),
])
def test_first_cell_compares_by_type(spark, sql, expected, passed):
    spec = [{"table": "t", "sql": sql, "expected_result": expected}]
    assert Q.report(Q.checks_from_specs(spark, spec)).first().passed is passed


def test_filled_check(spark):
    checks = Q.filled_checks({"a": spark.range(3), "b": spark.range(0)})
    assert [(r.actual, r.passed) for r in Q.report(checks).collect()] == [("3", True), ("0", False)]

"""Whole-pipeline properties: reruns, file order, layout vs table columns."""

import uuid

import pytest

from arrivals import contracts as C
from arrivals.plans import pipeline as P
from arrivals.sinks.tables import Warehouse
from arrivals.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pipeline_twice_same_tables(spark, tmp_root):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw")
    wh = Warehouse(spark, "p_" + uuid.uuid4().hex[:8], location=f"{tmp_root}/wh")
    rep = P.run_pipeline(spark, P.Inputs.of(paths), f"{tmp_root}/layout", wh)
    assert all(r.passed for r in rep.collect())
    first = {c.name: _rows(wh.read(c.name)) for c in C.ALL}
    P.run_pipeline(spark, P.Inputs.of(paths), f"{tmp_root}/layout", wh, parallel=False)
    second = {c.name: _rows(wh.read(c.name)) for c in C.ALL}
    assert first == second
    # Table columns never include layout columns.
    for c in C.ALL:
        assert wh.read(c.name).columns == c.names
    # The fact equals the de-duplicated records, one delivery or two.
    single = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw1", repeat_arrivals=False)
    wh1 = Warehouse(spark, "p_" + uuid.uuid4().hex[:8], location=f"{tmp_root}/wh1")
    P.run_pipeline(spark, P.Inputs.of(single), f"{tmp_root}/layout1", wh1)
    assert _rows(wh1.read("fact_immigration")) == first["fact_immigration"]


def test_sql_specs_run_against_the_warehouse(spark, tmp_root):
    from arrivals.operators import quality as Q
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    wh = Warehouse(spark, "p_" + uuid.uuid4().hex[:8], location=f"{tmp_root}/wh")
    P.run_pipeline(spark, P.Inputs.of(paths), f"{tmp_root}/layout", wh)
    specs = [
        {"table": "staging_state_temperature",
         "sql": "select count_if(month > 12) from staging_state_temperature", "expected_result": 0},
        {"table": "date_time", "sql": "select max(year) >= min(year) from date_time", "expected_result": True},
        {"table": "city_demographics", "sql": "select city from city_demographics where foreign_born < 0",
         "expected_result": ""},
        {"table": "fact_immigration", "sql": "SELECT COUNT(*) FROM fact_immigration", "expected_result": 0},
    ]
    spark.catalog.setCurrentDatabase(wh.database)
    try:
        rep = Q.report(Q.checks_from_specs(spark, specs)).collect()
    finally:
        spark.catalog.setCurrentDatabase("default")
    assert [r.passed for r in rep] == [True, True, True, False]
    assert int(rep[3].actual) == wh.read("fact_immigration").count()


def test_resume_skips_committed_outputs(spark, tmp_root):
    import os
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    out = f"{tmp_root}/layout"
    P.build_layout(spark, P.Inputs.of(paths), out)
    marker = f"{out}/{P.FACT_KEY}/_SUCCESS".replace("file:", "")
    before = os.path.getmtime(marker)
    P.build_layout(spark, P.Inputs.of(paths), out, resume=True)
    assert os.path.getmtime(marker) == before
    P.build_layout(spark, P.Inputs.of(paths), out, resume=False)
    assert os.path.getmtime(marker) >= before


def test_a_mistyped_input_leaves_everything_as_it_was(spark, tmp_root):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    for name, layout in (("copy", None), ("place", f"{tmp_root}/place")):
        out = f"{tmp_root}/{name}"
        wh = Warehouse(spark, f"m_{uuid.uuid4().hex[:8]}", location=f"{tmp_root}/wh_{name}",
                       fact_layout=P.fact_path(out) if layout else None)
        P.run_pipeline(spark, P.Inputs.of(paths), out, wh)
        before = _rows(wh.read("fact_immigration"))
        wrong = P.Inputs.of({**paths, "arrivals": f"{tmp_root}/raw/arivals"})
        with pytest.raises(Exception):
            P.run_pipeline(spark, wrong, out, wh, parallel=False)
        assert _rows(wh.read("fact_immigration")) == before
        assert spark.read.parquet(P.fact_path(out)).count() == len(before) > 0


def test_an_empty_fact_does_not_pass_the_gate(spark, tmp_root):
    wh = Warehouse(spark, f"e_{uuid.uuid4().hex[:8]}", location=f"{tmp_root}/wh")
    wh.create_tables()
    rep = {r.check_name: r.passed for r in P.quality_report(wh).collect()}
    assert not any(ok for n, ok in rep.items() if n.endswith("_has_rows")) and rep["fact_null_cic_id"]

"""The command line: config file, commands, exit status."""

import io
import json
import uuid
from contextlib import redirect_stdout

import pytest

from arrivals import contracts as C
from arrivals.plans import pipeline as P
from arrivals.plans.run import load_config, main
from arrivals.sinks import parquet as K
from arrivals.sinks.tables import Warehouse
from arrivals.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _config(tmp_path, paths, layout, database, location) -> str:
    cfg = tmp_path / "arrivals.cfg"
    cfg.write_text(
        "[inputs]\n"
        f"arrivals = {paths['arrivals']}\n"
        f"demographics = {paths['demographics']}\n"
        f"temperature = {paths['temperature']}\n"
        f"country_code = {paths['country_code']}\n"
        "[output]\n"
        f"layout = {layout}\n"
        "[warehouse]\n"
        f"database = {database}\n"
        f"location = {location}\n"
        "[run]\n"
        "years = 10\n")
    return str(cfg)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_all_then_a_seeded_defect_fails_the_check(spark, tmp_root, tmp_path):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw")
    db = "cli_" + uuid.uuid4().hex[:8]
    cfg = _config(tmp_path, paths, f"{tmp_root}/layout", db, f"{tmp_root}/wh")
    buf = io.StringIO()
    with redirect_stdout(buf):
        assert main(["all", "-c", cfg], spark=spark) == 0
    report = [json.loads(line) for line in buf.getvalue().splitlines()]
    names = [r["check_name"] for r in report]
    assert names[:3] == ["fact_null_cic_id", "state_temperature_null_avg", "country_code_duplicates"]
    assert {f"{c.name}_has_rows" for c in C.ALL} <= set(names)
    assert {"fact_immigration.arrival_date_not_null", "fact_immigration.arr_state_max_length"} <= set(names)
    assert all(r["passed"] for r in report)
    wh = Warehouse(spark, db)
    for c in C.ALL:
        assert wh.read(c.name).columns == c.names
        assert wh.read(c.name).count() > 0
    # The same as the library call.
    ref = Warehouse(spark, "cli_ref_" + uuid.uuid4().hex[:8], location=f"{tmp_root}/wh_ref")
    P.run_pipeline(spark, P.Inputs.of(paths), f"{tmp_root}/layout_ref", ref)
    assert _rows(wh.read("fact_immigration")) == _rows(ref.read("fact_immigration"))
    # A second copy of every country code row: the duplicate check fails.
    wh.load("country_code", spark.read.parquet(f"{tmp_root}/layout/{P.COUNTRY_KEY}"), "append")
    buf = io.StringIO()
    with redirect_stdout(buf):
        assert main(["check", "-c", cfg], spark=spark) == 1
    # The whole report is printed, the failed row included.
    report = {json.loads(line)["check_name"]: json.loads(line)["passed"]
              for line in buf.getvalue().splitlines()}
    assert len(report) > 9 and [n for n, ok in report.items() if not ok] == ["country_code_duplicates"]


def test_missing_setting_is_a_usage_error(spark, tmp_path):
    cfg = tmp_path / "bad.cfg"
    cfg.write_text("[output]\nlayout = /nowhere\n")
    assert main(["layout", "-c", str(cfg)], spark=spark) == 2
    assert main(["all", "--set", "no-dot=1"], spark=spark) == 2
    assert main(["daily", "--set", "output.layout=/x", "--set", "run.daily_max_files=0"],
                spark=spark) == 2


def test_overrides_and_defaults():
    cfg = load_config(None, ["output.layout=/x", "inputs.arrivals_option.encoding=utf-8"])
    assert cfg.get("output", "layout") == "/x"
    assert cfg.get("inputs", "arrivals_format") == "parquet"
    assert cfg.getint("run", "years") == 10
    assert cfg.get("inputs", "arrivals_option.encoding") == "utf-8"


def test_daily_runs_merge_only_new_deliveries(spark, tmp_root, tmp_path):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw")
    layout = f"{tmp_root}/layout"
    cfg = _config(tmp_path, paths, layout, "unused", "")
    sets = ["--set", f"run.daily_checkpoint={tmp_root}/daily-ckpt",
            "--set", "run.daily_max_files=7"]  # the backlog in several batches
    assert main(["daily", "-c", cfg, *sets], spark=spark) == 0
    fact_path = f"{layout}/{P.FACT_KEY}"
    first = _rows(spark.read.parquet(fact_path))
    # Nothing new arrived: the second run reads no file and adds nothing.
    assert main(["daily", "-c", cfg, *sets], spark=spark) == 0
    assert _rows(spark.read.parquet(fact_path)) == first
    # The same rows as the batch fact job over all deliveries.
    from arrivals.operators import transforms as J
    batch = P.read_arrivals(spark, P.Inputs.of(paths))
    expected = J.fact_arrivals(batch)
    got = spark.read.parquet(fact_path).select(*C.FACT_ARRIVALS.names)
    assert _rows(got) == _rows(expected)


def test_daily_source_log_lies_beside_the_layout_by_default(spark, tmp_root, tmp_path):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    layout = f"{tmp_root}/layout"
    cfg = _config(tmp_path, paths, layout, "unused", "")
    assert main(["daily", "-c", cfg], spark=spark) == 0
    fact_path = f"{layout}/{P.FACT_KEY}"
    n = spark.read.parquet(fact_path).count()
    # Another application has another checkpoint folder; the log stays the same.
    sc, before = spark.sparkContext, spark.sparkContext.getCheckpointDir()
    sc.setCheckpointDir(f"{tmp_root}/another")
    try:
        kept = spark.read.parquet(fact_path).filter("month = 3")
        K.replace_folder(spark, fact_path, lambda to: kept.write.partitionBy("year", "month").parquet(to))
        left = spark.read.parquet(fact_path).count()
        assert main(["daily", "-c", cfg], spark=spark) == 0
        assert spark.read.parquet(fact_path).count() == left < n  # no file was read again
    finally:
        sc._jsc.sc().setCheckpointDir(before)


def test_a_format_that_cannot_stream_is_refused(spark, tmp_root):
    from arrivals.streaming import ingest_deliveries
    spark.range(1).write.parquet(f"{tmp_root}/in")
    with pytest.raises(ValueError, match="cannot be read as a stream"):
        ingest_deliveries(spark, f"{tmp_root}/in", f"{tmp_root}/fact", f"{tmp_root}/log", fmt="binaryfilex")


def test_checks_file_adds_spec_checks(spark, tmp_root, tmp_path):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    db = "cli_" + uuid.uuid4().hex[:8]
    cfg = _config(tmp_path, paths, f"{tmp_root}/layout", db, f"{tmp_root}/wh")
    specs = [
        {"table": "city_demographics",
         "sql": "select count_if(tot_pop < male_pop + female_pop) as off from city_demographics",
         "expected_result": 0},
        {"table": "date_time", "sql": "select date from date_time where month not between 1 and 12",
         "expected_result": ""},
    ]
    good = tmp_path / "good.json"
    good.write_text(json.dumps(specs))
    buf = io.StringIO()
    with redirect_stdout(buf):
        assert main(["all", "-c", cfg, "--set", f"run.checks_file={good}"], spark=spark) == 0
    names = [json.loads(line)["check_name"] for line in buf.getvalue().splitlines()]
    assert names[-2:] == ["check_1", "check_2"]
    assert spark.catalog.currentDatabase() == "default"
    # A spec that cannot hold: the fact is not empty.
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps(specs + [{"table": "fact_immigration",
                                        "sql": "SELECT COUNT(*) FROM fact_immigration",
                                        "expected_result": 0}]))
    with redirect_stdout(io.StringIO()):
        assert main(["check", "-c", cfg, "--set", f"run.checks_file={bad}"], spark=spark) == 1
    (tmp_path / "wrong.json").write_text('{"sql": "SELECT 1"}')
    assert main(["check", "-c", cfg, "--set", f"run.checks_file={tmp_path / 'wrong.json'}"],
                spark=spark) == 2


def test_context_fills_path_templates(spark, tmp_root, tmp_path):
    cfg = load_config(None, ["inputs.arrivals=s3a://b/raw/{ds}/arrivals", "output.layout=/out/{ds}",
                             "inputs.arrivals_glob=*.{a,b}"], ["ds=2016-04-01"])
    assert cfg.get("inputs", "arrivals") == "s3a://b/raw/2016-04-01/arrivals"
    assert cfg.get("output", "layout") == "/out/2016-04-01"
    assert cfg.get("inputs", "arrivals_glob") == "*.{a,b}"  # globs are not templates
    assert main(["layout", "--set", "output.layout=/out/{run}", "--context", "ds=1"],
                spark=spark) == 2
    # A backfill: the same file, another context, another layout folder.
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    cfg_path = _config(tmp_path, paths, f"{tmp_root}/layout/{{ds}}", "unused", "")
    assert main(["layout", "-c", cfg_path, "--context", "ds=2016-04-01"], spark=spark) == 0
    fact = spark.read.parquet(f"{tmp_root}/layout/2016-04-01/{P.FACT_KEY}")
    assert fact.count() > 0

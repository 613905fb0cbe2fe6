"""The whole pipeline: raw files -> Parquet layout -> warehouse -> checks.

Stage 1 (raw to Parquet) builds the fact and three dimensions, each one
Spark job ending in a layout-aware write.  Stage 2 creates the warehouse
tables, writes new versions of all six from the four Parquet outputs and the
derived temperature and date dimensions, checks them and makes them current
together.  Independent jobs run from driver threads at the same time (Spark
schedules concurrent jobs from one session); the order between dependent
steps is the one of the original task graph.

Every step reads what the previous step wrote, never the previous step's
lineage, so a lost executor costs at most the step it was running, and the
written output is the restart point.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from arrivals import contracts as C
from arrivals.operators import quality as Q
from arrivals.operators import transforms as J
from arrivals.sinks import parquet as K
from arrivals.sinks.release import Release, report_of
from arrivals.sinks.tables import Warehouse
from arrivals.sources import raw as R
from arrivals.session import path_exists, scratch_dir
from arrivals.sources.files import read_csv, scan_files
from arrivals.streaming import daily as DY

# Output keys below the Parquet root, one per table.
FACT_KEY = "immigration/immigrations.parquet"
CITY_KEY = "city_demographic/cities.parquet"
STATE_TEMP_KEY = "state_temperature/states.parquet"
COUNTRY_KEY = "country_code/countries.parquet"


def fact_path(out: str) -> str:
    """Where the fact's Parquet layout lives below the output root ``out``.

    Give it to ``Warehouse(..., fact_layout=...)`` to register the fact in
    place instead of copying it on every load.
    """
    return f"{out.rstrip('/')}/{FACT_KEY}"


@dataclass
class Inputs:
    arrivals: str
    demographics: str
    temperature: str
    country_code: str
    arrivals_format: str = "parquet"
    arrivals_glob: str | None = "*.parquet"
    arrivals_options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, paths: Mapping[str, str], **kw) -> "Inputs":
        return cls(paths["arrivals"], paths["demographics"], paths["temperature"],
                   paths["country_code"], **kw)


def _run_all(jobs: list[Callable[[], object]], parallel: bool) -> list[object]:
    if not parallel or len(jobs) < 2:
        return [j() for j in jobs]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def read_arrivals(spark: SparkSession, inp: Inputs) -> DataFrame:
    raw = scan_files(spark, inp.arrivals, inp.arrivals_format, inp.arrivals_glob,
                     schema=R.RAW_ARRIVALS if inp.arrivals_format == "parquet" else None,
                     options=inp.arrivals_options)
    return raw.select(*J.ARRIVAL_COLUMNS)


def staged_temperature(raw: DataFrame, years: int) -> DataFrame:
    """The staging job over readings that are parsed once.

    The job takes the latest year and then filters by it; over a CSV that
    would parse the file twice, so the country's rows are kept as Parquet.
    """
    spark = raw.sparkSession
    kept = scratch_dir(spark, "country-readings")
    J.country_readings(raw).write.parquet(kept)
    return J.recent_readings(spark.read.parquet(kept), years)


def build_layout(spark: SparkSession, inp: Inputs, out: str, years: int = 10,
                 parallel: bool = True, resume: bool = False) -> dict[str, str]:
    """Stage 1: the four raw sources to partitioned Parquet under ``out``.

    With ``resume``, an output whose write committed before (its
    ``_SUCCESS`` marker exists) is kept and its job skipped, so a run that
    failed later restarts from the finished outputs.  Use it only when the
    inputs are unchanged since that run, e.g. with a per-run ``out``.
    """
    out = out.rstrip("/")
    paths = {k: f"{out}/{v}" for k, v in
             [("fact", FACT_KEY), ("city", CITY_KEY), ("temp", STATE_TEMP_KEY), ("country", COUNTRY_KEY)]}

    def done(key: str) -> bool:
        return resume and path_exists(spark, f"{paths[key]}/_SUCCESS")

    def fact():
        if done("fact"):
            return
        K.write_fact(J.fact_arrivals(read_arrivals(spark, inp)), paths["fact"])

    def city():
        if done("city"):
            return
        raw = read_csv(spark, inp.demographics, R.RAW_DEMOGRAPHICS, sep=";")
        K.write_by_column(J.city_demographics(raw), paths["city"], "state_code")

    def temp():
        if done("temp"):
            return
        raw = read_csv(spark, inp.temperature, R.RAW_TEMPERATURE)
        K.write_by_copy(staged_temperature(raw, years), paths["temp"], "state", "partition_state")

    def country():
        if done("country"):
            return
        K.write_overwrite(J.country_codes(read_csv(spark, inp.country_code, R.RAW_COUNTRY_CODES)),
                          paths["country"])

    _run_all([fact, city, temp, country], parallel)
    return paths


def write_release(spark: SparkSession, wh: Warehouse, out: str, years: int = 10,
                  parallel: bool = True) -> Release:
    """Stage 2: create tables, then new versions of all six from the layout and
    the two derived dimensions.  Nothing is current yet; a failed step leaves
    the warehouse as it was."""
    wh.create_tables()
    out = out.rstrip("/")
    new = Release(wh)

    def fact_then_dates():
        new.load("date_time", J.date_dim(new.stage("fact_immigration", out, FACT_KEY)))

    def staging_then_dim():
        new.load("state_temperature",
                 J.state_temperature_dim(new.stage("staging_state_temperature", out, STATE_TEMP_KEY), years))

    def city():
        new.stage("city_demographics", out, CITY_KEY)

    def country():
        new.stage("country_code", out, COUNTRY_KEY)

    try:
        _run_all([fact_then_dates, staging_then_dim, city, country], parallel)
    except BaseException:
        new.discard()
        raise
    return new


def load_warehouse(spark: SparkSession, wh: Warehouse, out: str, years: int = 10,
                   parallel: bool = True) -> None:
    """Stage 2 without an audit: all six tables become current together."""
    write_release(spark, wh, out, years, parallel).publish()


def add_new_dates(wh: Warehouse, fact_path: str,
                  months: list[tuple[int | None, int | None]]) -> None:
    """Append to ``date_time`` the arrival dates of ``months`` it lacks.

    A daily run's new dates can only lie in the months its deliveries
    touched, so only those folders' date column is read, not the whole
    fact.  The anti join on the date makes a repeated call add nothing.
    """
    stored = DY.read_months(wh.spark, fact_path, months)
    if stored is None:
        return
    known = wh.read("date_time").select("date")
    wh.load("date_time", J.date_dim(stored).join(known, "date", "left_anti"), "append")


def quality_report(wh: Warehouse, contracts: bool = False, rescan: bool = False) -> DataFrame:
    """The gating checks: the three of the original gate, that every table has
    rows, and NOT NULL and VARCHAR limits of every table.  ``contracts`` adds
    the declared keys.  Counts that loads have observed are taken from the
    manifest while the tables' files are unchanged, unless ``rescan``."""
    return report_of(wh.read, {} if rescan else wh.metrics(), wh.spark, contracts)


def run_pipeline(spark: SparkSession, inputs: Inputs, out: str, wh: Warehouse,
                 years: int = 10, parallel: bool = True, gate: bool = True,
                 contracts: bool = False, resume: bool = False) -> DataFrame:
    """Run both stages and the checks; return the check report.

    The second stage writes, audits and publishes: with ``gate`` a failed
    check raises :class:`DataQualityError` after all of them ran, and none of
    the six tables changes.  ``contracts`` adds the declared keys of all six
    tables to the report.
    """
    build_layout(spark, inputs, out, years, parallel, resume)
    new = write_release(spark, wh, out, years, parallel)
    try:
        rows = new.report(contracts).collect()  # one row per check
        rep = spark.createDataFrame(rows, Q.REPORT_SCHEMA)
        if gate:
            Q.assert_passed(rep)
    except BaseException:
        new.discard()
        raise
    new.publish()
    return rep

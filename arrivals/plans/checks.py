"""One Spark query per operator check, over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame.  Checks of
sinks and loads write below the shared scratch root (``spark.checkpoint.dir``)
and return the re-read output, so what is compared is what landed.
The matching DuckDB SQL is in :mod:`arrivals.plans.oracle`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals import contracts as C
from arrivals.functions.dates import sas_date
from arrivals.operators import analytics as A
from arrivals.operators import filters as Fl
from arrivals.operators import quality as Q
from arrivals.operators import setops as U
from arrivals.operators import transforms as J
from arrivals.plans import pipeline as P
from arrivals.plans.oracle import CHECK_YEARS, PIPELINE_YEARS
from arrivals.session import scratch_dir
from arrivals.sinks import months as MO
from arrivals.sinks import parquet as K
from arrivals.sinks.release import Release
from arrivals.sinks.tables import Warehouse
from arrivals.sources import files as S
from arrivals.sources import fixtures as FX
from arrivals.sources import raw as R

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared building blocks ---------------------------------------------

def _fact(spark, sf):
    return J.fact_arrivals(FX.raw_arrivals(spark, sf))


def _demographics(spark, sf):
    return J.city_demographics(FX.raw_demographics(spark, sf))


def _staging(spark, sf, years):
    return P.staged_temperature(FX.raw_temperature(spark, sf), years)


def _dim_st(spark, sf, years):
    return J.state_temperature_dim(_staging(spark, sf, years), years)


def _faulty_fact(spark, sf):
    return J.fact_arrivals(FX.raw_arrivals_with_defects(spark, sf))


def _faulty_dim_st(spark, sf, years):
    staging = P.staged_temperature(FX.raw_temperature_with_defects(spark, sf), years)
    return J.state_temperature_dim(staging, years)


def _warehouse(spark, label: str) -> Warehouse:
    db = f"{label}_{uuid.uuid4().hex[:10]}"
    return Warehouse(spark, db, location=scratch_dir(spark, db))


def _deliveries(spark, sf, copies: int = 1) -> str:
    """Arrival records written as monthly Parquet deliveries; the root path."""
    root = scratch_dir(spark, "arrivals-raw")
    raw = FX.raw_arrivals(spark, sf)
    month = F.date_format(sas_date("arrdate"), "yyyy-MM")
    laid = raw.withColumn("delivery", month)
    for b in range(1, copies + 1):
        K.write_partitioned(laid, f"{root}/batch={b}", ["delivery"])
    return root


def _csv(df: DataFrame, path: str, sep: str = ",") -> str:
    (df.write.mode("overwrite").option("header", "true").option("sep", sep)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return path


# ---- sources ------------------------------------------------------------

def scan_multi_file(spark, sf):
    root = _deliveries(spark, sf)
    return S.scan_files(spark, root, "parquet", "*.parquet", schema=R.RAW_ARRIVALS)


def scan_csv(spark, sf):
    path = _csv(FX.raw_temperature(spark, sf), scratch_dir(spark, "temperature-csv"))
    return S.read_csv(spark, path, R.RAW_TEMPERATURE)


def scan_csv_semicolon(spark, sf):
    path = _csv(FX.raw_demographics(spark, sf), scratch_dir(spark, "demographics-csv"), ";")
    return S.read_csv(spark, path, R.RAW_DEMOGRAPHICS, sep=";")


def csv_malformed_lines(spark, sf):
    """Lines of a code file that do not fit: every tenth code is no number."""
    c = FX.table(spark, sf, "customer")
    path = scratch_dir(spark, "malformed-csv")
    code = F.when(F.col("c_custkey") % 10 == 3, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))
                  ).otherwise(F.col("c_custkey").cast("string"))
    _csv(c.select(code.alias("code"), F.col("c_name").alias("country")), path)
    return S.malformed_lines(spark, path, R.RAW_COUNTRY_CODES).select(F.col(S.MALFORMED).alias("line"))


def scan_parquet(spark, sf):
    o = S.read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet")
    return o.select("o_orderkey", "o_custkey", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"))


def empty_typed_relation(spark, sf):
    """The fold's start: the typed empty relation, then every record."""
    empty = S.empty_frame(spark, R.RAW_ARRIVALS)
    return U.union_all([empty, FX.raw_arrivals(spark, sf)])


def scan_templated_path(spark, sf):
    root = _deliveries(spark, sf)
    return S.scan_templated(spark, root, "batch={batch}", {"batch": 1}).select(*J.ARRIVAL_COLUMNS)


def temp_view_query(spark, sf):
    view = f"arrivals_raw_{uuid.uuid4().hex[:8]}"
    return S.sql_on_view(FX.raw_arrivals(spark, sf), view,
                         f"SELECT i94addr AS arr_state, COUNT(*) AS n FROM {view} GROUP BY i94addr")


def table_read(spark, sf):
    wh = _warehouse(spark, "tread")
    wh.create_tables([C.COUNTRY_CODE])
    wh.load("country_code", FX.raw_country_codes_of_customers(spark, sf), "overwrite")
    return S.read_table(spark, wh.table("country_code"))


# ---- sinks and loads ----------------------------------------------------

def write_partitioned_year_month(spark, sf):
    path = scratch_dir(spark, "fact")
    K.write_fact(_fact(spark, sf), path)
    return spark.read.parquet(path)


def write_partitioned_by_column(spark, sf):
    path = scratch_dir(spark, "cities")
    K.write_by_column(_demographics(spark, sf), path, "state_code")
    return spark.read.parquet(path)


def write_partitioned_by_copy(spark, sf):
    path = scratch_dir(spark, "states")
    K.write_by_copy(_staging(spark, sf, CHECK_YEARS), path, "state", "partition_state")
    return spark.read.parquet(path)


def write_overwrite(spark, sf):
    path = scratch_dir(spark, "countries")
    cc = J.country_codes(FX.raw_country_codes_of_customers(spark, sf))
    K.write_overwrite(cc, path)
    K.write_overwrite(cc, path)  # a second run replaces, it does not add
    return spark.read.parquet(path)


def write_error_if_exists(spark, sf):
    path = scratch_dir(spark, "countries-new")
    cc = J.country_codes(FX.raw_country_codes_of_customers(spark, sf))
    K.write_new(cc, path)
    try:
        K.write_new(cc, path)
    except AnalysisException:
        pass
    else:
        raise AssertionError("second write to an existing path did not fail")
    return spark.read.parquet(path)


def load_stage_overwrite(spark, sf):
    out = scratch_dir(spark, "layout")
    K.write_fact(_fact(spark, sf), f"{out}/{P.FACT_KEY}")
    wh = _warehouse(spark, "stage")
    wh.create_tables()
    for _ in range(2):  # a rerun leaves one copy
        wh.stage("fact_immigration", out, "immigration/{name}.parquet", {"name": "immigrations"})
    return wh.read("fact_immigration")


def load_stage_in_place(spark, sf):
    """The fact staged by registering its layout (no copy), twice."""
    out = scratch_dir(spark, "layout")
    K.write_fact(_fact(spark, sf), P.fact_path(out))
    db = f"inplace_{uuid.uuid4().hex[:10]}"
    wh = Warehouse(spark, db, location=scratch_dir(spark, db), fact_layout=P.fact_path(out))
    wh.create_tables([C.FACT_ARRIVALS])
    for _ in range(2):  # a rerun registers the same folders again
        wh.stage("fact_immigration", out, P.FACT_KEY)
    return wh.read("fact_immigration")


def load_fact_overwrite(spark, sf):
    wh = _warehouse(spark, "factload")
    wh.create_tables([C.FACT_ARRIVALS])
    view = f"fact_src_{uuid.uuid4().hex[:8]}"
    _fact(spark, sf).createOrReplaceTempView(view)
    for _ in range(2):
        wh.insert_select("fact_immigration", C.FACT_ARRIVALS.names,
                         f"SELECT {', '.join(C.FACT_ARRIVALS.names)} FROM {view}", "overwrite")
    return wh.read("fact_immigration")


def load_dimension_overwrite(spark, sf):
    wh = _warehouse(spark, "dimload")
    wh.create_tables([C.STATE_TEMPERATURE])
    dim = _dim_st(spark, sf, CHECK_YEARS)
    for _ in range(2):
        wh.load("state_temperature", dim, "overwrite")
    return wh.read("state_temperature")


def load_dimension_append(spark, sf):
    wh = _warehouse(spark, "dimappend")
    wh.create_tables([C.DATE_TIME])
    dim = J.date_dim(_fact(spark, sf))
    for _ in range(2):
        wh.load("date_time", dim, "append")
    return wh.read("date_time")


def insert_column_list(spark, sf):
    """INSERT with a column list in another order than the table's."""
    wh = _warehouse(spark, "collist")
    wh.create_tables([C.DATE_TIME])
    view = f"dates_{uuid.uuid4().hex[:8]}"
    J.date_dim(_fact(spark, sf)).createOrReplaceTempView(view)
    cols = list(reversed(C.DATE_TIME.names))
    wh.insert_select("date_time", cols, f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}",
                     "overwrite")
    return wh.read("date_time")


def create_tables(spark, sf):
    """All six tables, created twice (idempotent) and loaded: their columns and rows."""
    wh = _warehouse(spark, "ddl")
    wh.create_tables()
    wh.create_tables()
    fact, staging = _fact(spark, sf), _staging(spark, sf, CHECK_YEARS)
    frames = {"fact_immigration": fact, "date_time": J.date_dim(fact),
              "city_demographics": _demographics(spark, sf), "staging_state_temperature": staging,
              "state_temperature": J.state_temperature_dim(staging, CHECK_YEARS),
              "country_code": J.country_codes(FX.raw_country_codes_of_customers(spark, sf))}
    shape = {n: ", ".join(f"{r.col_name} {r.data_type}" for r in spark.sql(f"DESCRIBE {wh.table(n)}").collect())
             for n in frames}
    for name, df in frames.items():
        wh.load(name, df, "overwrite")
    return (Q.row_counts({n: wh.read(n) for n in frames})
            .select("table_name", F.create_map(*[F.lit(x) for kv in shape.items() for x in kv])[F.col("table_name")]
                    .alias("columns"), F.col("n").alias("n_rows")))


# ---- projections --------------------------------------------------------

def project_columns(spark, sf):
    return FX.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")


def project_rename(spark, sf):
    return J.rename(FX.raw_demographics(spark, sf), J.DEMOGRAPHICS_RENAME)


def fact_typed_projection(spark, sf):
    return _fact(spark, sf)


def fact_bad_values(spark, sf):
    """Values that do not fit their type, and records that merge once typed."""
    return _faulty_fact(spark, sf)


def project_cast_keep_name(spark, sf):
    return J.cast_keep_names(J.rename(FX.raw_demographics(spark, sf), J.DEMOGRAPHICS_RENAME),
                             J.DEMOGRAPHICS_TYPES)


def derive_columns(spark, sf):
    t = FX.raw_temperature(spark, sf).select("dt", F.col("State").alias("state"))
    return t.withColumns({"month": F.month("dt"), "year": F.year("dt"),
                          "partition_state": F.col("state")})


def drop_column(spark, sf):
    raw = FX.raw_arrivals(spark, sf)
    return raw.withColumn("arrival_date", sas_date("arrdate")).drop("arrdate")


# ---- filters ------------------------------------------------------------

def filter_unprojected_col(spark, sf):
    t = Fl.equals(FX.raw_temperature(spark, sf), "Country", "United States")
    return t.select("dt", F.col("AverageTemperature").alias("avg_temp"), F.col("State").alias("state"))


def recent_window_filter(spark, sf):
    return _staging(spark, sf, CHECK_YEARS)


def dq_null_count(spark, sf):
    return Q.null_count(_faulty_fact(spark, sf), "cic_id")


def dq_duplicate_keys(spark, sf):
    c = FX.table(spark, sf, "customer").select(F.col("c_nationkey").alias("code"),
                                               F.col("c_mktsegment").alias("country"))
    return Q.duplicate_groups(c, ["code", "country"], counted="code")


# ---- aggregation, distinct, sort, set operations ------------------------

def distinct_rows(spark, sf):
    return FX.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").dropDuplicates()


def union_distinct_fold(spark, sf):
    root = _deliveries(spark, sf, copies=2)
    batches = [S.scan_files(spark, f"{root}/batch={b}", "parquet", "*.parquet", schema=R.RAW_ARRIVALS)
               for b in (1, 2)]
    return U.union_distinct(batches)


def global_max(spark, sf):
    return FX.table(spark, sf, "lineitem").agg(F.max(F.year("l_shipdate")).alias("max_year"))


def dim_state_temperature(spark, sf):
    return _dim_st(spark, sf, CHECK_YEARS)


def dim_state_temperature_sql(spark, sf):
    from arrivals.plans.sql import state_temperature_sql
    view = f"staging_{uuid.uuid4().hex[:8]}"
    _staging(spark, sf, CHECK_YEARS).createOrReplaceTempView(view)
    return state_temperature_sql(spark, view, CHECK_YEARS)


def order_by_keys(spark, sf):
    return (FX.table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name")
            .orderBy("c_nationkey", "c_custkey"))


def union_all_positional(spark, sf):
    s = FX.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("nm"))
    c = FX.table(spark, sf, "customer").select("c_custkey", "c_name")
    return U.union_all([s, c])


# ---- scalar functions ---------------------------------------------------

def sas_date_convert(spark, sf):
    raw = FX.raw_arrivals(spark, sf)
    return raw.select(F.col("cicid").try_cast("bigint").alias("cic_id"),
                      sas_date("arrdate").alias("arrival_date"))


def partition_columns(spark, sf):
    f = _fact(spark, sf)
    return (f.groupBy(F.year("arrival_date").alias("year"), F.month("arrival_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("n")))


def dim_date_time(spark, sf):
    return J.date_dim(_fact(spark, sf))


def dim_date_time_sql(spark, sf):
    from arrivals.plans.sql import date_time_sql
    view = f"fact_{uuid.uuid4().hex[:8]}"
    _fact(spark, sf).createOrReplaceTempView(view)
    return date_time_sql(spark, view)


# ---- quality and contracts ----------------------------------------------

def dq_null_measure(spark, sf):
    return Q.null_count(_faulty_dim_st(spark, sf, CHECK_YEARS), "avg_temperature")


def contract_not_null(spark, sf):
    return Q.not_null_counts(_faulty_fact(spark, sf), C.FACT_ARRIVALS)


def contract_unique_key(spark, sf):
    return Q.key_duplicates(_demographics(spark, sf), C.CITY_DEMOGRAPHICS)


def contract_max_length(spark, sf):
    return Q.too_long_counts(_faulty_fact(spark, sf), C.FACT_ARRIVALS)


def contract_schema(spark, sf):
    df = C.CITY_DEMOGRAPHICS.conform(_demographics(spark, sf))
    problems = Q.schema_problems(df, C.CITY_DEMOGRAPHICS)
    if problems:
        raise AssertionError(problems)
    return df


def contract_report(spark, sf):
    return Q.contract_report(_faulty_fact(spark, sf), C.FACT_ARRIVALS)


def dq_report(spark, sf):
    cc = J.country_codes(FX.country_codes_with_defects(spark, sf))
    return Q.report(Q.reference_checks(_faulty_fact(spark, sf), _faulty_dim_st(spark, sf, PIPELINE_YEARS), cc))


def dq_row_count(spark, sf):
    """How many rows each table of a run would have; the gate wants some in each."""
    fact = _fact(spark, sf)
    return Q.row_counts({
        "fact_immigration": fact, "date_time": J.date_dim(fact), "city_demographics": _demographics(spark, sf),
        "country_code": J.country_codes(FX.raw_country_codes_of_customers(spark, sf))})


# ---- jobs ---------------------------------------------------------------

def job_fact_arrivals(spark, sf):
    root = _deliveries(spark, sf, copies=2)
    inp = P.Inputs(root, "", "", "")
    return J.fact_arrivals(P.read_arrivals(spark, inp))


def job_city_demographics(spark, sf):
    path = _csv(FX.raw_demographics(spark, sf), scratch_dir(spark, "demographics-csv"), ";")
    return J.city_demographics(S.read_csv(spark, path, R.RAW_DEMOGRAPHICS, sep=";"))


def job_state_temperature_staging(spark, sf):
    path = _csv(FX.raw_temperature(spark, sf), scratch_dir(spark, "temperature-csv"))
    return P.staged_temperature(S.read_csv(spark, path, R.RAW_TEMPERATURE), PIPELINE_YEARS)


def job_country_code(spark, sf):
    path = _csv(FX.raw_country_codes_of_customers(spark, sf), scratch_dir(spark, "country-csv"))
    return J.country_codes(S.read_csv(spark, path, R.RAW_COUNTRY_CODES))


def job_fact_incremental(spark, sf):
    """Two daily runs: the first sees one delivery, the second a repeat of it."""
    from arrivals.streaming import ingest_deliveries
    work = scratch_dir(spark, "incremental")
    src, fact_path, ckpt = f"{work}/incoming", f"{work}/fact", f"{work}/_source_log"
    raw = FX.raw_arrivals(spark, sf)
    laid = raw.withColumn("delivery", F.date_format(sas_date("arrdate"), "yyyy-MM"))
    K.write_partitioned(laid, f"{src}/day=1", ["delivery"])
    ingest_deliveries(spark, src, fact_path, ckpt)
    K.write_partitioned(laid, f"{src}/day=2", ["delivery"])
    ingest_deliveries(spark, src, fact_path, ckpt)
    return spark.read.parquet(fact_path).select(*C.FACT_ARRIVALS.names)


def job_fact_corrections(spark, sf):
    """Four daily runs merged by arrival id: all records, corrections that also
    move the arrival to another month, corrections of these, and a repeat."""
    from arrivals.streaming import ingest_deliveries
    work = scratch_dir(spark, "corrections")
    src, fact_path, ckpt = f"{work}/incoming", f"{work}/fact", f"{work}/_source_log"
    raw = FX.raw_arrivals(spark, sf)
    k = F.col("cicid").cast("bigint")
    moved = raw.filter(k % 7 == 1).withColumns({"i94bir": F.col("i94bir") + 1, "arrdate": F.col("arrdate") + 40})
    again = raw.filter(k % 21 == 1).withColumns({"i94bir": F.lit(99.0), "gender": F.lit("X")})
    for day, delivery in enumerate((raw, moved, again, again), 1):
        delivery.write.parquet(f"{src}/day={day}")
        ingest_deliveries(spark, src, fact_path, ckpt, merge="keys")
    return spark.read.parquet(fact_path).select(*C.FACT_ARRIVALS.names)


def load_backfill_period(spark, sf):
    """A fact built from wrong deliveries, and half a year of it built anew."""
    path = scratch_dir(spark, "backfill")
    raw = FX.raw_arrivals(spark, sf)
    K.write_fact(J.fact_arrivals(raw.withColumn("i94bir", F.col("i94bir") + 5)), path)
    for _ in range(2):  # a rerun leaves the same rows
        MO.backfill(spark, raw, path, (1994, 10), (1995, 3))
    return spark.read.parquet(path)


def compact_months(spark, sf):
    """The fact appended in five deliveries, then its small files packed."""
    path = scratch_dir(spark, "compaction")
    fact = _fact(spark, sf)
    for part in range(5):
        K.write_fact(fact.filter(F.col("cic_id") % 5 == part), path, "append")
    MO.compact(spark, path, 1 << 20)
    files = spark.read.parquet(path).select("year", "month", F.col("_metadata.file_path").alias("file"))
    return files.groupBy("year", "month").agg(F.count_distinct("file").alias("n_files"),
                                              F.count(F.lit(1)).alias("n_rows"))


def _six_tables(spark, sf):
    fact, staging = _fact(spark, sf), _staging(spark, sf, PIPELINE_YEARS)
    return {"fact_immigration": fact, "date_time": J.date_dim(fact), "city_demographics": _demographics(spark, sf),
            "staging_state_temperature": staging,
            "state_temperature": J.state_temperature_dim(staging, PIPELINE_YEARS),
            "country_code": J.country_codes(FX.raw_country_codes_of_customers(spark, sf))}


def load_audited(spark, sf):
    """A release that passes its audit and is published, and one that does not:
    all six tables keep the rows of the first."""
    wh = _warehouse(spark, "audited")
    wh.create_tables()
    good = Release(wh)
    for name, df in _six_tables(spark, sf).items():
        good.load(name, df)
    Q.assert_passed(good.report())
    good.publish()
    bad = Release(wh)
    for c in C.ALL:
        bad.load(c.name, wh.read(c.name).limit(10))
    bad.load("country_code", J.country_codes(FX.country_codes_with_defects(spark, sf)))
    try:
        Q.assert_passed(bad.report(), log=lambda *_: None)
    except Q.DataQualityError:
        bad.discard()
    else:
        raise AssertionError("an audit passed repeated country codes")
    return _table_sums(wh)


def dq_observed(spark, sf):
    """The report of a release over faulty records, counted by its own writes."""
    wh = _warehouse(spark, "observed")
    wh.create_tables()
    new = Release(wh)
    short = {"arr_state": F.substring("arr_state", 1, 3), "visa_type": F.substring("visa_type", 1, 3)}
    new.load("fact_immigration", _faulty_fact(spark, sf).withColumns(short))
    new.load("state_temperature", _faulty_dim_st(spark, sf, PIPELINE_YEARS))
    new.load("country_code", J.country_codes(FX.country_codes_with_defects(spark, sf)))
    rows = new.report().filter(F.col("table_name").isin(*new.versions)).collect()  # one row per check
    new.discard()
    return spark.createDataFrame(rows, Q.REPORT_SCHEMA)


def _kept_counts(spark, sf):
    """Arrivals per state and month kept up by three daily runs, the last a repeat."""
    from arrivals.streaming import ingest_deliveries
    from arrivals.streaming import maintained as MA
    work = scratch_dir(spark, "kept-counts")
    src, fact_path, counts = f"{work}/incoming", f"{work}/fact", f"{work}/counts"
    raw = FX.raw_arrivals(spark, sf)
    first = sas_date("arrdate") < F.lit("1996-06-15").cast("date")
    for day, delivery in enumerate((raw.filter(first), raw.filter(~first), raw.filter(~first)), 1):
        delivery.write.parquet(f"{src}/day={day}")
        ingest_deliveries(spark, src, fact_path, f"{work}/_source_log",
                          after_merge=lambda months: MA.refresh_travel_counts(spark, fact_path, counts, months))
    return MA.travel_counts(spark, counts)


def travel_counts_incremental(spark, sf):
    return _kept_counts(spark, sf).select("arr_state", "year", "month", "arrivals")


def corr_incremental(spark, sf):
    """Both correlations from the kept counts and the kept sums of readings."""
    from arrivals.streaming import maintained as MA
    counts, demo = _kept_counts(spark, sf), _demographics(spark, sf)
    work = scratch_dir(spark, "kept-sums")
    MA.merge_readings(spark, FX.raw_temperature(spark, sf), f"{work}/readings", f"{work}/sums")
    dim = MA.state_temperature_of_sums(spark, f"{work}/sums", PIPELINE_YEARS)
    both = [("demographics", A.corr_counts_demographics(counts, demo)),
            ("temperature", A.corr_counts_temperature(counts, A.state_bridge(demo), dim))]
    return U.union_all([df.select(F.lit(name).alias("analysis"), "r") for name, df in both])


def dim_state_temperature_incremental(spark, sf):
    """The temperature dimension kept up by three deliveries that overlap."""
    from arrivals.streaming import maintained as MA
    work = scratch_dir(spark, "kept-temperature")
    raw = FX.raw_temperature(spark, sf)
    year = F.year("dt")
    for delivery in (raw.filter(year < 1995), raw.filter((year >= 1994) & (year < 1998)), raw.filter(year >= 1997)):
        MA.merge_readings(spark, delivery, f"{work}/readings", f"{work}/sums")
    return MA.state_temperature_of_sums(spark, f"{work}/sums", CHECK_YEARS)


def dim_date_time_incremental(spark, sf):
    """The date dimension kept up by daily runs into an in-place warehouse.

    The warehouse is built from the deliveries before 1997; a second daily
    run then sees every delivery (the earlier ones again) and adds only the
    dates it lacks.  The result must equal the dimension of the whole fact.
    """
    from arrivals.streaming import ingest_deliveries
    work = scratch_dir(spark, "dates-incremental")
    src, ckpt = f"{work}/incoming", f"{work}/_source_log"
    fact_path = P.fact_path(f"{work}/layout")
    laid = FX.raw_arrivals(spark, sf).withColumn(
        "delivery", F.date_format(sas_date("arrdate"), "yyyy-MM"))
    K.write_partitioned(laid.filter(F.col("delivery") < "1997-01"), f"{src}/day=1", ["delivery"])
    ingest_deliveries(spark, src, fact_path, ckpt)
    db = f"dates_{uuid.uuid4().hex[:10]}"
    wh = Warehouse(spark, db, location=scratch_dir(spark, db), fact_layout=fact_path)
    wh.create_tables([C.FACT_ARRIVALS, C.DATE_TIME])
    wh.register("fact_immigration")
    wh.load("date_time", J.date_dim(wh.read("fact_immigration")), "overwrite")
    K.write_partitioned(laid, f"{src}/day=2", ["delivery"])
    ingest_deliveries(spark, src, fact_path, ckpt,
                      after_merge=lambda months: P.add_new_dates(wh, fact_path, months))
    wh.register("fact_immigration")
    return wh.read("date_time")


def job_pipeline(spark, sf):
    root = scratch_dir(spark, "pipeline")
    paths = FX.write_raw_inputs(spark, sf, f"{root}/raw")
    wh = Warehouse(spark, "pipeline_" + uuid.uuid4().hex[:10], location=f"{root}/warehouse")
    P.run_pipeline(spark, P.Inputs.of(paths), f"{root}/layout", wh, PIPELINE_YEARS)
    return _table_sums(wh)


def _table_sums(wh):
    """Each table by its rows and the sum of a column."""
    sums = {"fact_immigration": "cic_id", "date_time": "day", "city_demographics": "count",
            "staging_state_temperature": "month", "state_temperature": "month", "country_code": "code"}
    parts = [wh.read(n).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(c).cast("bigint").alias("total"))
             .select(F.lit(n).alias("table_name"), "n_rows", "total") for n, c in sums.items()]
    return U.union_all(parts)


# ---- analyses -----------------------------------------------------------

def travel_by_state_month(spark, sf):
    return A.travel_by_state_month(_fact(spark, sf))


def corr_travel_demographics(spark, sf):
    return A.corr_travel_demographics(_fact(spark, sf), _demographics(spark, sf))


def corr_travel_temperature(spark, sf):
    return A.corr_travel_temperature(_fact(spark, sf), A.state_bridge(_demographics(spark, sf)),
                                     _dim_st(spark, sf, PIPELINE_YEARS))


def queries() -> dict[str, Query]:
    names = [
        "scan_multi_file", "scan_csv", "scan_csv_semicolon", "csv_malformed_lines", "scan_parquet", "empty_typed_relation",
        "scan_templated_path", "temp_view_query", "table_read",
        "write_partitioned_year_month", "write_partitioned_by_column", "write_partitioned_by_copy",
        "write_overwrite", "write_error_if_exists", "load_stage_overwrite", "load_stage_in_place",
        "load_fact_overwrite",
        "load_dimension_overwrite", "load_dimension_append", "insert_column_list", "create_tables",
        "project_columns", "project_rename", "fact_typed_projection", "fact_bad_values", "project_cast_keep_name",
        "derive_columns", "drop_column",
        "filter_unprojected_col", "recent_window_filter", "dq_null_count", "dq_duplicate_keys",
        "distinct_rows", "union_distinct_fold", "global_max", "dim_state_temperature",
        "dim_state_temperature_sql",
        "order_by_keys", "union_all_positional",
        "sas_date_convert", "partition_columns", "dim_date_time", "dim_date_time_sql",
        "dim_date_time_incremental",
        "dq_null_measure", "contract_not_null", "contract_unique_key", "contract_max_length",
        "contract_schema", "contract_report", "dq_report", "dq_row_count",
        "job_fact_arrivals", "job_city_demographics", "job_state_temperature_staging",
        "job_country_code", "job_fact_incremental", "job_pipeline",
        "job_fact_corrections", "load_backfill_period", "compact_months", "load_audited", "dq_observed",
        "dim_state_temperature_incremental", "travel_counts_incremental", "corr_incremental",
        "travel_by_state_month", "corr_travel_demographics", "corr_travel_temperature",
    ]
    g = globals()
    return {n: g[n] for n in names}

"""The incremental daily run: pruned reads of the stored fact, idempotent replays."""

from arrivals.plans import pipeline as P
from arrivals.operators import transforms as J
from arrivals.sinks import parquet as K
from arrivals.sources import raw as R
from arrivals.streaming import daily as D


def _raw(spark, rows):
    return spark.createDataFrame(rows, R.RAW_ARRIVALS)


ROWS = [
    (1.0, 100.0, 100.0, 20454.0, 1.0, "NY", 30.0, 2.0, 1986.0, "F", "B2"),  # 2016-01-01
    (2.0, 101.0, 101.0, 20485.0, 1.0, "CA", 40.0, 1.0, 1976.0, "M", "B1"),  # 2016-02-01
    (3.0, 102.0, 102.0, None, 1.0, "TX", 50.0, 2.0, 1966.0, None, "WT"),     # no date
    (4.0, 102.0, 102.0, float("nan"), 2.0, "TX", 51.0, 2.0, 1965.0, "F", "WT"),  # no date
]


def test_touched_months_include_the_null_folder(spark):
    months = set(D.touched_months(_raw(spark, ROWS)))
    assert months == {(2016, 1), (2016, 2), (None, None)}


def test_stored_fact_read_is_partition_pruned(spark, tmp_root):
    K.write_fact(J.fact_arrivals(_raw(spark, ROWS)), f"{tmp_root}/fact")
    pruned = spark.read.parquet(f"{tmp_root}/fact").filter(D._in_months([(2016, 2)]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    part = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in part and "month" in part and "2016" in part
    assert [r.cic_id for r in pruned.collect()] == [2]
    with_null = spark.read.parquet(f"{tmp_root}/fact").filter(D._in_months([(None, None)]))
    assert sorted(r.cic_id for r in with_null.collect()) == [3, 4]


def test_replayed_delivery_adds_nothing_even_without_dates(spark, tmp_root):
    src, fact, ckpt = f"{tmp_root}/in", f"{tmp_root}/fact", f"{tmp_root}/_log"
    raw = _raw(spark, ROWS)
    raw.write.parquet(f"{src}/day=1")
    D.ingest_deliveries(spark, src, fact, ckpt)
    raw.write.parquet(f"{src}/day=2")  # the same records again
    raw.limit(1).write.parquet(f"{src}/day=3")
    D.ingest_deliveries(spark, src, fact, ckpt)
    got = spark.read.parquet(fact).select(*J.fact_arrivals(raw).columns)
    want = J.fact_arrivals(P.read_arrivals(spark, P.Inputs(src, "", "", "")))
    assert got.count() == 4
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_fact_files_sorted_by_id_within_each_month(spark, tmp_root):
    import glob
    import pyarrow.parquet as pq
    from arrivals.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    path = f"{tmp_root}/fact"
    K.write_fact(J.fact_arrivals(FX.raw_arrivals(spark, SF_SMALL)), path)
    from arrivals.session import local_fs_path
    files = glob.glob(f"{local_fs_path(path)}/year=*/month=*/*.parquet")
    assert files
    for f in files:
        ids = [i for i in pq.read_table(f, columns=["cic_id"]).column(0).to_pylist() if i is not None]
        assert ids == sorted(ids)


def _scan_rows(df) -> int:
    """Rows the Parquet scan of an executed plan produced (after row-group skipping)."""
    out = []

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(p.plan())
        if name == "FileSourceScanExec":
            out.append(int(p.metrics().apply("numOutputRows").value()))
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(out)


def test_id_range_skips_row_groups_of_the_stored_fact(spark, tmp_root):
    from pyspark.sql import functions as F
    n = 200_000
    rows = spark.range(n).select(
        F.col("id").cast("double").alias("cicid"),
        *[F.lit(1.0).alias(c) for c in ("i94cit", "i94res")],
        F.lit(20454.0).alias("arrdate"), F.lit(1.0).alias("i94mode"), F.lit("NY").alias("i94addr"),
        *[F.lit(1.0).alias(c) for c in ("i94bir", "i94visa", "biryear")],
        F.lit("F").alias("gender"), F.lit("B2").alias("visatype"))
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    old = hconf.get("parquet.block.size")
    hconf.set("parquet.block.size", str(256 * 1024))  # many row groups in a small file
    try:
        K.write_fact(J.fact_arrivals(rows), f"{tmp_root}/fact")
    finally:
        if old is None:
            hconf.unset("parquet.block.size")
        else:
            hconf.set("parquet.block.size", old)
    # All rows sit in one month: partition pruning alone would read them all.
    stored = spark.read.parquet(f"{tmp_root}/fact").filter(
        D._in_months([(2016, 1)]) & D._in_ids(1000, 1010, False))
    assert sorted(r.cic_id for r in stored.collect()) == list(range(1000, 1011))
    assert _scan_rows(stored) < n // 4


def test_replays_with_null_and_out_of_range_ids_stay_exact(spark, tmp_root):
    src, fact, ckpt = f"{tmp_root}/in", f"{tmp_root}/fact", f"{tmp_root}/_log"
    # NaN is a non-convertible id: typed, it becomes a null cic_id.
    null_id = [(float("nan"), 5.0, 5.0, 20454.0, 1.0, "NY", 30.0, 2.0, 1986.0, "F", "B2")]
    first = _raw(spark, ROWS + null_id)
    first.write.parquet(f"{src}/day=1")
    D.ingest_deliveries(spark, src, fact, ckpt)
    # Copies of a null-id row and an old row, one row with a new id, and a
    # row that differs from a stored one only in a measure.
    again = null_id + [ROWS[0],
                       (10.0, 1.0, 1.0, 20454.0, 1.0, "NY", 30.0, 2.0, 1986.0, "F", "B2"),
                       (1.0, 100.0, 100.0, 20454.0, 1.0, "NY", 31.0, 2.0, 1986.0, "F", "B2")]
    _raw(spark, again).write.parquet(f"{src}/day=2")
    D.ingest_deliveries(spark, src, fact, ckpt)
    got = spark.read.parquet(fact).select(*J.fact_arrivals(first).columns)
    want = J.fact_arrivals(P.read_arrivals(spark, P.Inputs(src, "", "", "")))
    assert got.count() == want.count() == 7
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_merge_lists_only_the_touched_month_folders(spark, tmp_root):
    from arrivals.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    from pyspark.sql import functions as F
    fact = f"{tmp_root}/fact"
    raw = FX.raw_arrivals(spark, SF_SMALL)
    K.write_fact(J.fact_arrivals(raw), fact)
    assert len(spark.read.parquet(fact).select("year", "month").distinct().collect()) > 12
    # A batch of one month, plus a null-date row whose folder is not stored.
    first = raw.agg(F.min("arrdate")).first()[0]
    batch = raw.filter(F.col("arrdate") == first).unionByName(
        _raw(spark, [ROWS[2]]))
    unseen = D.unseen_rows(spark, batch, fact)
    scan = [ln for ln in unseen._jdf.queryExecution().executedPlan().toString().splitlines()
            if "FileScan parquet" in ln][0]
    assert "InMemoryFileIndex(1 paths)" in scan
    # Only the null-date row is new.
    assert [r.cic_id for r in unseen.collect()] == [3]


def test_daily_run_before_any_delivery_does_nothing(spark, tmp_root):
    src, fact, ckpt = f"{tmp_root}/in", f"{tmp_root}/fact", f"{tmp_root}/_log"
    D.ingest_deliveries(spark, src, fact, ckpt)  # the folder does not exist yet
    from arrivals.session import path_exists
    assert not path_exists(spark, fact)
    _raw(spark, ROWS).write.parquet(f"{src}/day=1")
    D.ingest_deliveries(spark, src, fact, ckpt)
    assert spark.read.parquet(fact).count() == 4

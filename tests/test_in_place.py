"""The fact registered over its layout instead of copied into the warehouse."""

import datetime as dt
import os
import uuid

import pytest

from arrivals import contracts as C
from arrivals.plans import pipeline as P
from arrivals.plans.run import main
from arrivals.session import local_fs_path
from arrivals.sinks.tables import Warehouse
from arrivals.sources import fixtures as FX
from arrivals.sources import raw as R
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _db(prefix="ip"):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def test_in_place_pipeline_gives_the_same_tables_without_a_copy(spark, tmp_root):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw")
    copy = Warehouse(spark, _db(), location=f"{tmp_root}/wh_copy")
    P.run_pipeline(spark, P.Inputs.of(paths), f"{tmp_root}/out_copy", copy)
    out = f"{tmp_root}/out"
    wh = Warehouse(spark, _db(), location=f"{tmp_root}/wh", fact_layout=P.fact_path(out))
    rep = P.run_pipeline(spark, P.Inputs.of(paths), out, wh)
    assert all(r.passed for r in rep.collect())
    for c in C.ALL:
        assert wh.read(c.name).columns == c.names
        assert _rows(wh.read(c.name)) == _rows(copy.read(c.name)), c.name
    # The fact's files are the layout's; the warehouse holds no copy of them.
    assert not os.path.exists(local_fs_path(f"{tmp_root}/wh/fact_immigration"))
    files = spark.table(wh.table("fact_immigration")).inputFiles()
    assert files and all(local_fs_path(P.fact_path(out)) in local_fs_path(f) for f in files)
    # Month filters prune folders through the catalog's partitions.
    one = spark.table(wh.table("fact_immigration")).filter("year = 1995 AND month = 3")
    scan = [ln for ln in one._jdf.queryExecution().executedPlan().toString().splitlines()
            if "FileScan" in ln][0]
    assert "PartitionFilters: [" in scan and "1995" in scan.split("PartitionFilters: [")[1]


def _fact_rows(spark, rows):
    ddl = ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in C.FACT_ARRIVALS.columns)
    return spark.createDataFrame(rows, ddl)


ROW = (1, 1, 1, 1, "NY", 30, 2, 1986, "F", "B2", dt.date(2016, 4, 1))


def test_in_place_overwrite_and_append_go_through_the_layout(spark, tmp_root):
    layout = f"{tmp_root}/fact"
    wh = Warehouse(spark, _db(), location=f"{tmp_root}/wh", fact_layout=layout)
    wh.create_tables([C.FACT_ARRIVALS])
    may = (2,) + ROW[1:-1] + (dt.date(2016, 5, 2),)
    wh.load("fact_immigration", _fact_rows(spark, [ROW, may]), "overwrite")
    assert wh.read("fact_immigration").count() == 2
    wh.load("fact_immigration", _fact_rows(spark, [ROW]), "append")
    assert wh.read("fact_immigration").count() == 3
    # An overwrite without May: the May folder and its partition are gone.
    wh.load("fact_immigration", _fact_rows(spark, [ROW]), "overwrite")
    assert _rows(wh.read("fact_immigration")) == [ROW]
    months = spark.sql(f"SHOW PARTITIONS {wh.table('fact_immigration')}").collect()
    assert [r[0] for r in months] == ["year=2016/month=4"]


def test_in_place_refuses_to_replace_a_copied_table(spark, tmp_root):
    db = _db()
    copy = Warehouse(spark, db, location=f"{tmp_root}/wh")
    copy.create_tables([C.FACT_ARRIVALS])
    copy.load("fact_immigration", _fact_rows(spark, [ROW]), "overwrite")
    in_place = Warehouse(spark, db, fact_layout=f"{tmp_root}/fact")
    with pytest.raises(ValueError, match="copied table"):
        in_place.register("fact_immigration")
    assert copy.read("fact_immigration").count() == 1


def test_daily_run_shows_new_rows_in_the_in_place_table(spark, tmp_root, tmp_path):
    paths = FX.write_raw_inputs(spark, SF_SMALL, f"{tmp_root}/raw", repeat_arrivals=False)
    db = _db("ipcli")
    cfg = tmp_path / "a.cfg"
    cfg.write_text(
        "[inputs]\n" + "".join(f"{k} = {v}\n" for k, v in paths.items())
        + f"[output]\nlayout = {tmp_root}/layout\n"
        + f"[warehouse]\ndatabase = {db}\nlocation = {tmp_root}/wh\nfact_in_place = true\n"
        + f"[run]\ndaily_checkpoint = {tmp_root}/ckpt\n")
    import io
    from contextlib import redirect_stdout
    with redirect_stdout(io.StringIO()):
        assert main(["all", "-c", str(cfg)], spark=spark) == 0
    wh = Warehouse(spark, db)
    before = wh.read("fact_immigration").count()
    # The daily run reads every delivery once (all known rows), then a new one.
    assert main(["daily", "-c", str(cfg)], spark=spark) == 0
    assert wh.read("fact_immigration").count() == before
    new = spark.createDataFrame(
        [(99_999_999.0, 1.0, 1.0, 30000.5, 1.0, "NY", 30.0, 2.0, 1986.0, "F", "B2")], R.RAW_ARRIVALS)
    new.write.parquet(f"{paths['arrivals']}/batch=1/delivery=2042-02")
    assert main(["daily", "-c", str(cfg)], spark=spark) == 0
    got = wh.read("fact_immigration")
    assert got.count() == before + 1
    want = dt.date(1960, 1, 1) + dt.timedelta(days=int(30000.5))
    assert got.filter("cic_id = 99999999").first().arrival_date == want
    # The date dimension gained the new date, and equals a full rebuild.
    from arrivals.operators import transforms as J
    dates = wh.read("date_time")
    assert dates.filter(dates.date == want).count() == 1
    assert _rows(dates) == _rows(J.date_dim(got))
    # Adding the same months again changes nothing.
    P.add_new_dates(wh, P.fact_path(f"{tmp_root}/layout"), [(2042, 2)])
    assert _rows(wh.read("date_time")) == _rows(dates)


def test_register_keeps_the_table_and_drops_only_vanished_months(spark, tmp_root):
    from arrivals.sinks import parquet as K
    from arrivals.sinks.tables import _partition_sql
    layout = f"{tmp_root}/fact"
    wh = Warehouse(spark, _db(), fact_layout=layout)
    no_date = (3,) + ROW[1:-1] + (None,)
    K.write_fact(_fact_rows(spark, [ROW, no_date]), layout)
    wh.register("fact_immigration")
    t = wh.table("fact_immigration")

    def created():  # the catalog's creation time in milliseconds
        ss = spark._jsparkSession.sessionState()
        ident = ss.sqlParser().parseTableIdentifier(f"{wh.database}.fact_immigration")
        return ss.catalog().getTableMetadata(ident).createTime()

    first_created = created()
    assert sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()) == [
        "year=2016/month=4", "year=__HIVE_DEFAULT_PARTITION__/month=__HIVE_DEFAULT_PARTITION__"]
    may = (2,) + ROW[1:-1] + (dt.date(2016, 5, 2),)
    K.write_fact(_fact_rows(spark, [may]), layout)  # a rewrite with May only
    wh.register("fact_immigration")
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()] == ["year=2016/month=5"]
    assert [r.cic_id for r in wh.read("fact_immigration").collect()] == [2]
    assert created() == first_created  # the same table: never dropped and made again
    assert _partition_sql("year=__HIVE_DEFAULT_PARTITION__/month=7") == "`year`=NULL, `month`=7"
    with pytest.raises(ValueError):
        _partition_sql("year=1; DROP TABLE x/month=1")


def test_add_new_dates_is_a_no_op_without_stored_months(spark, tmp_root):
    wh = Warehouse(spark, _db(), location=f"{tmp_root}/wh")
    wh.create_tables([C.DATE_TIME])
    P.add_new_dates(wh, f"{tmp_root}/no-fact", [(2016, 4)])  # no fact folder at all
    from arrivals.sinks import parquet as K
    K.write_fact(_fact_rows(spark, [ROW]), f"{tmp_root}/fact")
    P.add_new_dates(wh, f"{tmp_root}/fact", [(2030, 1)])  # a month with no folder
    assert wh.read("date_time").count() == 0
    P.add_new_dates(wh, f"{tmp_root}/fact", [(2016, 4)])
    assert [r.date for r in wh.read("date_time").collect()] == [dt.date(2016, 4, 1)]

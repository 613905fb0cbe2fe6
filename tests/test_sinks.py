import datetime as dt
import os
import uuid

import pytest
from pyspark.errors import AnalysisException

from arrivals import contracts as C
from arrivals.sinks import parquet as K
from arrivals.sinks.tables import Warehouse


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def _wh(spark, tmp_root):
    db = "t_" + uuid.uuid4().hex[:8]
    return Warehouse(spark, db, location=f"{tmp_root}/{db}")


def test_fact_layout_year_month(spark, tmp_root):
    fact = spark.createDataFrame(
        [(i, dt.date(2016, 1 + i % 3, 1)) for i in range(30)], "cic_id bigint, arrival_date date")
    K.write_fact(fact, f"{tmp_root}/f")
    back = spark.read.parquet(f"{tmp_root}/f")
    assert sorted(back.columns) == ["arrival_date", "cic_id", "month", "year"]
    assert back.count() == 30
    dirs = sorted(os.listdir(_local(f"{tmp_root}/f/year=2016")))
    assert dirs == ["month=1", "month=2", "month=3"]
    # Files carry only the table columns; layout values live in folder names.
    leaf = spark.read.parquet(f"{tmp_root}/f/year=2016/month=1")
    assert leaf.columns == ["cic_id", "arrival_date"]


def test_partition_column_leaves_file_but_copy_keeps_it(spark, tmp_root):
    df = spark.createDataFrame([("a", "TX", 1), ("b", "CA", 2)], "city string, state_code string, n int")
    K.write_by_column(df, f"{tmp_root}/c", "state_code")
    assert spark.read.parquet(f"{tmp_root}/c/state_code=TX").columns == ["city", "n"]
    st = spark.createDataFrame([("Texas", 1.0)], "state string, t double")
    K.write_by_copy(st, f"{tmp_root}/s", "state")
    assert spark.read.parquet(f"{tmp_root}/s/partition_state=Texas").columns == ["state", "t"]


def test_overwrite_twice_one_copy_and_error_if_exists(spark, tmp_root):
    df = spark.range(10)
    K.write_overwrite(df, f"{tmp_root}/o")
    K.write_overwrite(df, f"{tmp_root}/o")
    assert spark.read.parquet(f"{tmp_root}/o").count() == 10
    K.write_new(df, f"{tmp_root}/n")
    with pytest.raises(AnalysisException):
        K.write_new(df, f"{tmp_root}/n")


def test_loads_overwrite_append_and_mode_required(spark, tmp_root):
    wh = _wh(spark, tmp_root)
    wh.create_tables()
    wh.create_tables()  # idempotent
    cc = spark.createDataFrame([(1, " A"), (2, " B")], "code bigint, country string")
    wh.load("country_code", cc, "overwrite")
    wh.load("country_code", cc, "overwrite")
    assert wh.read("country_code").count() == 2
    wh.load("country_code", cc, "append")
    assert wh.read("country_code").count() == 4
    with pytest.raises(ValueError):
        wh.load("country_code", cc, "")
    assert [f.dataType.simpleString() for f in wh.read("country_code").schema.fields] == ["int", "string"]


def test_varchar_limit_enforced_on_load(spark, tmp_root):
    wh = _wh(spark, tmp_root)
    wh.create_tables([C.DATE_TIME])
    bad = spark.createDataFrame([(dt.date(2016, 1, 1), 1, 53, "1", 2016, "x" * 30)],
                                "date date, day int, week int, month string, year int, weekday string")
    with pytest.raises(Exception):
        wh.load("date_time", bad, "overwrite")


def test_stage_templated_key_drops_layout_columns(spark, tmp_root):
    fact = spark.createDataFrame(
        [(1, 2, 3, 1, "NY", 30, 2, 1986, "F", "B2", dt.date(2016, 4, 1))],
        ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in C.FACT_ARRIVALS.columns))
    K.write_fact(fact, f"{tmp_root}/out/2016-04-01/immigrations.parquet")
    wh = _wh(spark, tmp_root)
    wh.create_tables([C.FACT_ARRIVALS])
    t = wh.stage("fact_immigration", f"{tmp_root}/out", "{ds}/immigrations.parquet", {"ds": "2016-04-01"})
    assert t.columns == C.FACT_ARRIVALS.names and t.count() == 1
    with pytest.raises(KeyError):
        wh.stage("fact_immigration", f"{tmp_root}/out", "{ds}/x", {})


def test_insert_column_list_maps_by_name(spark, tmp_root):
    wh = _wh(spark, tmp_root)
    wh.create_tables([C.STATE_TEMPERATURE])
    out = wh.insert_select("state_temperature", ["avg_temperature", "month", "state"],
                           "SELECT CAST(1.5 AS FLOAT), 7, 'Texas'", "append").first()
    assert (out.state, out.month, out.avg_temperature) == ("Texas", 7, 1.5)


def test_hot_layout_value_split_into_several_files(spark, tmp_root):
    # One month holds two thirds of the rows: with adaptive execution the
    # rebalance splits it into advisory-size pieces, so no single task
    # writes the whole folder.
    from pyspark.sql import functions as F
    df = (spark.range(60000).repartition(8)
          .withColumn("m", F.when(F.col("id") < 40000, 1).otherwise(F.col("id") % 5))
          .withColumn("pad", F.sha2(F.col("id").cast("string"), 256)))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        K.write_partitioned(df, f"{tmp_root}/hot", ["m"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = [f for f in os.listdir(_local(f"{tmp_root}/hot/m=1")) if f.endswith(".parquet")]
    assert len(hot) > 1
    # small values are merged, not written by every input task
    cold = [len([f for f in os.listdir(_local(f"{tmp_root}/hot/m={m}")) if f.endswith(".parquet")])
            for m in (0, 2, 3, 4)]
    assert min(cold) == 1
    assert spark.read.parquet(f"{tmp_root}/hot").count() == 60000


def test_layout_balancing_without_adaptive_execution(spark, tmp_root):
    from pyspark.sql import functions as F
    df = spark.range(3000).withColumn("m", F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 5))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        balanced = K.balanced_for_layout(df, ["m"])
        sizes = [len(p) for p in balanced.rdd.glom().collect()]
        K.write_partitioned(df, f"{tmp_root}/noaqe", ["m"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the hot value (2/3 of rows) is spread over several tasks
    assert max(sizes) < 2000
    assert spark.read.parquet(f"{tmp_root}/noaqe").count() == 3000


def _breaking(df):
    """Rows of which the last breaks inside a write task."""
    from pyspark.sql import functions as F
    last = F.col(df.columns[0]) == 99
    return df.withColumn(df.columns[0], F.when(last, F.raise_error(F.lit("broken row")).cast("int"))
                         .otherwise(F.col(df.columns[0])))


def test_a_failed_overwrite_keeps_the_old_rows(spark, tmp_root):
    wh = _wh(spark, tmp_root)
    wh.create_tables([C.COUNTRY_CODE])
    wh.load("country_code", spark.createDataFrame([(1, "A")], "code int, country string"), "overwrite")
    bad = _breaking(spark.createDataFrame([(2, "B"), (99, "C")], "code int, country string"))
    with pytest.raises(Exception):
        wh.load("country_code", bad, "overwrite")
    bad.createOrReplaceTempView("bad_codes")
    with pytest.raises(Exception):
        wh.insert_select("country_code", ["code", "country"], "SELECT code, country FROM bad_codes", "overwrite")
    assert [tuple(r) for r in wh.read("country_code").collect()] == [(1, "A")]
    assert not [t for t in spark.catalog.listTables(wh.database) if "_v_" in t.name]
    wh.load("country_code", spark.createDataFrame([(3, "D")], "code int, country string"), "overwrite")
    wh.load("country_code", spark.createDataFrame([(4, "E")], "code int, country string"), "append")
    assert sorted(r.code for r in wh.read("country_code").collect()) == [3, 4]


def test_a_failed_layout_write_keeps_the_old_folder(spark, tmp_root):
    old = spark.createDataFrame([(1, "TX")], "n int, state string")
    for write in (lambda d, p: K.write_by_column(d, p, "state"), K.write_overwrite):
        path = f"{tmp_root}/w{id(write)}"
        write(old, path)
        with pytest.raises(Exception):
            write(_breaking(spark.createDataFrame([(2, "CA"), (99, "CA")], "n int, state string")), path)
        assert [r.n for r in spark.read.parquet(path).collect()] == [1]
        assert [f for f in os.listdir(_local(path.rsplit("/", 1)[0])) if ".new-" in f or ".old-" in f] == []


def test_paths_are_asked_of_the_default_filesystem(spark, tmp_root):
    """With a default filesystem that is not local, paths without a scheme are its own."""
    from arrivals.sources import raw as R
    from arrivals.streaming import daily as DY
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    os.makedirs(_local(f"{tmp_root}/mount"))
    conf.set("fs.viewfs.mounttable.checks.link./data", f"file://{_local(f'{tmp_root}/mount')}")
    conf.set("fs.defaultFS", "viewfs://checks/")
    try:
        row = (1.0, 1.0, 1.0, 20545.5, 1.0, "NY", 30.0, 2.0, 1986.0, "F", "B2")
        batch = spark.createDataFrame([row, (2.0, *row[1:])], R.RAW_ARRIVALS)
        for _ in range(2):
            DY.merge_into_fact(spark, batch, "/data/fact")
        assert spark.read.parquet("/data/fact").count() == 2
        wh = Warehouse(spark, "t_" + uuid.uuid4().hex[:8], location=f"file://{_local(tmp_root)}/wh",
                       fact_layout="viewfs://checks/data/fact")
        for _ in range(2):
            wh.register("fact_immigration")
        assert wh.read("fact_immigration").count() == 2
    finally:
        conf.set("fs.defaultFS", before)


def test_order_by_keys_is_ordered(spark):
    from arrivals.plans import checks
    from tests.conftest import SF_SMALL
    got = [(r.c_nationkey, r.c_custkey) for r in checks.order_by_keys(spark, SF_SMALL).collect()]
    assert got == sorted(got) and len(got) > 100

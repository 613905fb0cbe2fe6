"""Exchanged files of the fact: upserts, backfills, compaction, and crashes between steps."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.operators import transforms as J
from arrivals.session import path_exists
from arrivals.sinks import months as M
from arrivals.sinks import parquet as K
from arrivals.sources import raw as R
from arrivals.streaming import corrections as X
from arrivals.streaming import daily as D


def record(i, day, age=30.0, state="NY"):
    return (None if i is None else float(i), 100.0, 100.0, day, 1.0, state, age, 2.0, 1986.0, "F", "B2")


def _raw(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType) for f in R.RAW_ARRIVALS]))


def _rows(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(D.STORED_SCHEMA).parquet(path).collect()), key=str)


def _names(spark, path):
    return {f.path for f in M.stored_files(spark, path)}


JAN, FEB, MAR = 20454.0, 20485.0, 20514.0  # days in 2016


def latest(deliveries):
    """The stored rows by brute force: the last record of each id, null ids by row."""
    by, loose = {}, set()
    for rows in deliveries:
        now = {}
        for r in rows:
            if r[0] is None:
                loose.add(r)
            else:
                now[r[0]] = max(now.get(r[0], r), r, key=lambda x: [(v is not None, v) for v in x[1:]])
        by |= now
    return [*by.values(), *loose]


def test_later_deliveries_win_in_any_month(spark, tmp_root):
    rnd = random.Random(5)
    path, done = f"{tmp_root}/fact", []
    for n in range(4):
        rows = [record(rnd.randrange(40), rnd.choice((JAN, FEB, MAR, None)), float(rnd.randrange(20, 60)))
                for _ in range(25)]
        # One record an id and delivery, so that brute force needs no order of columns.
        rows = list({r[0]: r for r in rows}.values()) + [record(None, JAN, 33.0)] * 2
        done.append(rows)
        X.upsert_into_fact(spark, _raw(spark, rows).repartition(3), path)
        want = M.with_layout(J.fact_arrivals(_raw(spark, latest(done))))
        assert _rows(spark, path) == sorted((tuple(r) for r in want.collect()), key=str)
        files = _names(spark, path)
        assert X.upsert_into_fact(spark, _raw(spark, rows), path) == []  # a repeat rewrites nothing
        assert _names(spark, path) == files


def test_only_files_with_changed_rows_are_rewritten(spark, tmp_root):
    path = f"{tmp_root}/fact"
    X.upsert_into_fact(spark, _raw(spark, [record(1, JAN), record(2, FEB), record(3, MAR)]), path)
    before = _names(spark, path)
    assert X.upsert_into_fact(spark, _raw(spark, [record(2, MAR, 50.0)]), path) == [(2016, 2), (2016, 3)]
    after = _names(spark, path)
    assert {f for f in before if "month=1/" in f or "month=3/" in f} < after
    assert not any("month=2/" in f for f in after)  # its only row has moved
    assert [r[0] for r in _rows(spark, path) if r[-1] == 3] == [2, 3]


def test_the_latest_file_of_one_micro_batch_wins(spark, tmp_root):
    import os
    src = f"{tmp_root}/in"
    for day, age in ((1, 20.0), (2, 40.0), (3, 30.0)):
        _raw(spark, [record(7, JAN, age)]).coalesce(1).write.parquet(f"{src}/day={day}")
    local = src.removeprefix("file:")
    for day, at in ((1, 3e9 / 2), (2, 1.4e9), (3, 1.45e9)):  # the first folder holds the latest file
        for f in os.listdir(f"{local}/day={day}"):
            os.utime(f"{local}/day={day}/{f}", (at, at))
    D.ingest_deliveries(spark, src, f"{tmp_root}/fact", f"{tmp_root}/_log", merge="keys")
    assert [r[5] for r in _rows(spark, f"{tmp_root}/fact")] == [20]
    with pytest.raises(ValueError):
        D.ingest_deliveries(spark, src, f"{tmp_root}/fact", f"{tmp_root}/_log", merge="ids")


@pytest.mark.parametrize("step", ["first move", "first delete", "last delete"])
def test_a_crash_between_steps_is_completed(spark, tmp_root, monkeypatch, step):
    path = f"{tmp_root}/fact"
    first = [record(i, (JAN, FEB)[i % 2]) for i in range(10)]
    fix = [record(i, MAR if i == 3 else JAN, 77.0) for i in range(0, 10, 3)]
    X.upsert_into_fact(spark, _raw(spark, first), path)
    X.upsert_into_fact(spark, _raw(spark, fix), f"{tmp_root}/other")
    real = {n: getattr(M, n) for n in ("rename_path", "delete_path")}
    seen = {"rename_path": 0, "delete_path": 0}

    def dying(name, at):
        def call(*args):
            if name == "rename_path" or "part-" in str(args[1]):
                seen[name] += 1
                if seen[name] == at:
                    raise RuntimeError("driver lost")
            return real[name](*args)
        return call

    name, at = {"first move": ("rename_path", 1), "first delete": ("delete_path", 1),
                "last delete": ("delete_path", 2)}[step]
    monkeypatch.setattr(M, name, dying(name, at))
    with pytest.raises(RuntimeError):
        X.upsert_into_fact(spark, _raw(spark, fix), path)
    monkeypatch.undo()
    assert path_exists(spark, f"{path}/{M.JOURNAL}")
    X.upsert_into_fact(spark, _raw(spark, fix), path)  # the replay
    want = M.with_layout(J.fact_arrivals(_raw(spark, latest([first, fix]))))
    assert _rows(spark, path) == sorted((tuple(r) for r in want.collect()), key=str)
    assert not path_exists(spark, f"{path}/{M.JOURNAL}") and not M.complete(spark, path)


def test_backfill_replaces_exactly_its_months(spark, tmp_root):
    path = f"{tmp_root}/fact"
    old = [record(i, (JAN, FEB, MAR, None)[i % 4], 20.0) for i in range(12)]
    K.write_fact(J.fact_arrivals(_raw(spark, old)), path)
    before = _names(spark, path)
    new = [record(i, (JAN, FEB, MAR, None)[i % 4], 50.0) for i in range(0, 12, 2)]
    assert M.backfill(spark, _raw(spark, new), path, (2016, 2), (2016, 3)) == [(2016, 2), (2016, 3)]
    kept = {f for f in before if "month=2/" not in f and "month=3/" not in f}
    assert kept < _names(spark, path)
    want = {(r[0], r[6]) for r in old if r[3] in (JAN, None)} | {(r[0], r[6]) for r in new if r[3] in (FEB, MAR)}
    assert {(r[0], r[5]) for r in _rows(spark, path)} == want
    M.backfill(spark, _raw(spark, []), path, (2016, 2), (2016, 2))  # nothing there any more
    assert not any("month=2/" in f for f in _names(spark, path))
    with pytest.raises(ValueError):
        M.backfill(spark, _raw(spark, new), path, (2016, 3), (2016, 2))
    rows = M.with_layout(J.fact_arrivals(_raw(spark, new)))
    files = _names(spark, path)
    with pytest.raises(ValueError, match="outside"):
        M.replace_months(spark, rows, path, [(2016, 1)])
    assert _names(spark, path) == files and not path_exists(spark, f"{path}/{M.JOURNAL}")


def test_compaction_after_many_daily_runs(spark, tmp_root):
    path = f"{tmp_root}/fact"
    big = _raw(spark, [record(100_000 + i, JAN, float(i % 70)) for i in range(3000)])
    K.write_fact(J.fact_arrivals(big).coalesce(1), path)
    (large,) = M.stored_files(spark, path)
    for day in range(30):
        D.merge_into_fact(spark, _raw(spark, [record(1000 * day + i, (JAN, FEB)[i % 2]) for i in range(20)]), path)
    rows, files = _rows(spark, path), M.stored_files(spark, path)
    assert len(files) >= 60
    target = large.size
    assert set(M.compact(spark, path, target)) == {"year=2016/month=1", "year=2016/month=2"}
    after = M.stored_files(spark, path)
    assert _rows(spark, path) == rows
    assert large.path in {f.path for f in after}  # a full-size file stays
    for folder in ("year=2016/month=1", "year=2016/month=2"):
        small = [f for f in files if f.folder == folder and 2 * f.size < target]
        new = [f for f in after if f.folder == folder and f.path != large.path]
        assert len(new) <= M.packed(small, target) and all(f.size <= target for f in new)
    # Files hold disjoint ranges of ids, in order.
    spans = (spark.read.parquet(path).filter("cic_id < 100000")
             .groupBy("year", "month", F.col("_metadata.file_path").alias("f"))
             .agg(F.min("cic_id").alias("lo"), F.max("cic_id").alias("hi")).orderBy("year", "month", "lo").collect())
    assert all(a.month != b.month or a.hi < b.lo for a, b in zip(spans, spans[1:]))
    # Footers of many tiny files made the sizes look larger; it soon settles.
    assert any(M.compact(spark, path, target) == {} for _ in range(4))
    assert _rows(spark, path) == rows


def test_compaction_cuts_a_large_month_into_ranges(spark, tmp_root):
    path = f"{tmp_root}/fact"
    rnd = random.Random(2)
    for _ in range(8):
        rows = [record(rnd.randrange(10**9), JAN, float(rnd.randrange(90)), rnd.choice("ABCDE")) for _ in range(2000)]
        K.write_fact(J.fact_arrivals(_raw(spark, rows)).coalesce(1), path, "append")
    rows, files = _rows(spark, path), M.stored_files(spark, path)
    assert len(files) == 8
    target = 3 * max(f.size for f in files)
    assert M.compact(spark, path, target) == {"year=2016/month=1": 8}
    new = M.stored_files(spark, path)
    assert len(new) == 3 and all(f.size < 1.1 * target for f in new) and _rows(spark, path) == rows
    spans = (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f"))
             .agg(F.min("cic_id").alias("lo"), F.max("cic_id").alias("hi")).orderBy("lo").collect())
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))

"""Corrected arrival records: an upsert of the fact by arrival id.

The later delivery of an id wins, also when the arrival moves to another
month.  The merge is copy-on-write by file: only files that hold a row whose
content changes are rewritten, and a delivery that repeats what is stored
rewrites nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.contracts import FACT_ARRIVALS
from arrivals.operators.transforms import ARRIVAL_COLUMNS, typed_arrivals
from arrivals.session import delete_path, path_exists, scratch_dir
from arrivals.sinks import months as M
from arrivals.streaming.daily import STORED_SCHEMA

#: Columns that say which of two deliveries is later.
DELIVERED = ["_delivered_at", "_delivered_in"]


def with_delivery(files: DataFrame) -> DataFrame:
    """Raw records of a file source with the columns of ``DELIVERED``: the
    file's time and, among files of one time, its path."""
    return files.select(*ARRIVAL_COLUMNS, F.col("_metadata.file_modification_time").alias(DELIVERED[0]),
                        F.col("_metadata.file_path").alias(DELIVERED[1]))


def latest_records(batch: DataFrame) -> DataFrame:
    """One typed row per arrival id, the latest delivered; of rows of one file
    the greatest.  Rows without an id have no key: each distinct one stays.

    The latest is a maximum, combined on the map side, so an id that holds a
    third of all records is one row per task when it is shuffled.
    """
    typed = typed_arrivals(batch, keep=[c for c in DELIVERED if c in batch.columns])
    order = [c for c in typed.columns if c in DELIVERED]
    columns = [c for c in FACT_ARRIVALS.names if c != "cic_id"]
    latest = (typed.filter("cic_id is not null").groupBy("cic_id")
              .agg(F.max(F.struct(*order, *columns)).alias("row")).select("cic_id", *[f"row.{c}" for c in columns]))
    return latest.unionByName(typed.filter("cic_id is null").select(*FACT_ARRIVALS.names).distinct())


def upsert_into_fact(spark: SparkSession, batch: DataFrame, fact_path: str) -> list[M.Month]:
    """Merge a batch of raw records into the fact by arrival id.

    Returns the months whose rows changed.  A replayed batch finds its rows
    stored and changes nothing.  The stored ids are read with the batch's id
    range pushed down; joins are left to the planner's size statistics.
    """
    M.complete(spark, fact_path)
    kept = scratch_dir(spark, "corrections-batch")
    M.with_layout(latest_records(batch)).write.parquet(kept)
    new = spark.read.schema(STORED_SCHEMA).parquet(kept)
    gone: list[str] = []
    rows = new
    hits = scratch_dir(spark, "corrections-stored")
    changes = scratch_dir(spark, "corrections-changes")
    if path_exists(spark, fact_path) and M.stored_files(spark, fact_path):
        stored = spark.read.schema(STORED_SCHEMA).parquet(fact_path)
        span = new.agg(F.min("cic_id").alias("lo"), F.max("cic_id").alias("hi"),
                       F.count_if(F.col("cic_id").isNull()).alias("nulls")).first()
        near = F.col("cic_id").between(span["lo"], span["hi"]) if span["lo"] is not None else F.lit(False)
        if span["nulls"]:
            near = near | F.col("cic_id").isNull()
        ids = new.select(F.col("cic_id").alias("id")).distinct()
        held = stored.filter(near).withColumn("file", F.col("_metadata.file_path"))
        # What is stored under the batch's ids: as many rows as the batch has, at most.
        held.join(ids, held["cic_id"].eqNullSafe(ids["id"]), "left_semi").write.parquet(hits)
        old = spark.read.parquet(hits)
        same = reduce(lambda a, b: a & b, [new[c].eqNullSafe(old[c]) for c in FACT_ARRIVALS.names])
        new.join(old, same, "left_anti").write.parquet(changes)
        rows = spark.read.schema(STORED_SCHEMA).parquet(changes)
        changed = rows.filter("cic_id is not null").select(F.col("cic_id").alias("id"))
        touched = (old.join(changed, old["cic_id"] == changed["id"], "left_semi")
                   .select("file").distinct().collect())  # files, not rows
        gone = sorted(M.file_of(r["file"]) for r in touched)
    months = [(r["year"], r["month"]) for r in rows.select(*M.LAYOUT).distinct().collect()]
    if months:
        if gone:
            root = fact_path.rstrip("/")
            files = (spark.read.schema(STORED_SCHEMA).option("basePath", root)
                     .parquet(*[f"{root}/{p}" for p in gone]))
            stay = files.join(changed, files["cic_id"] == changed["id"], "left_anti")
            rows = rows.unionByName(stay)
        M.exchange(spark, rows, fact_path, gone)
    for path in (kept, hits, changes):
        delete_path(spark, path)
    return sorted({*months, *(M.month_of(p) for p in gone)}, key=str)


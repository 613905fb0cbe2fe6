"""The daily fact run, incrementally: only files that arrived since the last run.

The batch job (J1 + K1) re-reads every delivery ever received and rewrites
the fact; its cost grows with the whole history.  Here the delivery folder
is a Structured Streaming file source run with ``trigger(availableNow=True)``
once per schedule tick: the source's checkpoint remembers which files were
already read, so each run reads only new files, then stops.

Each micro-batch is typed and de-duplicated like the batch job and merged
into the partitioned fact with a left anti join against the rows already
stored in the same (year, month) folders, comparing whole rows null-safely.
Only stored rows whose arrival id lies in the batch's id range (or is null,
when the batch has null ids) can match, so that range is pushed into the
stored scan too: the fact's files are sorted by id within each month, and
Parquet skips row groups outside the range.
The result is the same set of rows the batch job would produce, and the merge
is idempotent: a micro-batch that is replayed after a failure finds its rows
already present and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.contracts import FACT_ARRIVALS
from arrivals.operators.transforms import ARRIVAL_COLUMNS, fact_arrivals
from arrivals.session import delete_path, folders_below, path_exists, scratch_dir
from arrivals.sinks.months import complete
from arrivals.sinks.parquet import FACT_CLUSTER, NULL_FOLDER, write_partitioned
from arrivals.sources.raw import RAW_ARRIVALS

LAYOUT = ["year", "month"]

Summary = list[tuple[int | None, int | None, int | None, int | None, bool]]


def _with_layout(fact: DataFrame) -> DataFrame:
    return fact.withColumns({"year": F.year("arrival_date"), "month": F.month("arrival_date")})


def batch_summary(batch: DataFrame) -> Summary:
    """Per (year, month) folder a raw micro-batch writes into: id range, null ids."""
    return _summary(_with_layout(fact_arrivals(batch.select(*ARRIVAL_COLUMNS))))


def _summary(typed: DataFrame) -> Summary:
    """One aggregate over two columns of the typed batch.  The result has one
    row per folder, so it is bounded by the calendar (at most 12 per year of
    years 1-9999, plus one null folder for rows without a date), not by the
    data, and may come to the driver.
    """
    rows = (typed.groupBy(*LAYOUT)
            .agg(F.min("cic_id").alias("lo"), F.max("cic_id").alias("hi"),
                 F.bool_or(F.col("cic_id").isNull()).alias("null_ids"))
            .collect())
    return [(r.year, r.month, r.lo, r.hi, bool(r.null_ids)) for r in rows]


def touched_months(batch: DataFrame) -> list[tuple[int | None, int | None]]:
    """The (year, month) folders a raw micro-batch writes into."""
    return [(y, m) for y, m, *_ in batch_summary(batch)]


def _in_ids(lo: int | None, hi: int | None, null_ids: bool) -> Column:
    """Stored rows that can equal a batch row: id in the batch's range, or null."""
    c = F.col("cic_id")
    cond = c.between(lo, hi) if lo is not None else F.lit(False)
    return cond | c.isNull() if null_ids else cond


def _in_months(months: list[tuple[int | None, int | None]]) -> Column:
    """Partition filter on the layout columns covering ``months``.

    Kept to ``IN`` / ``IS NULL`` on each layout column so the Parquet scan
    lists only matching folders (static partition pruning); it may admit a
    few extra folders (year x month product), which the exact anti join
    then sees as non-matching.
    """
    cond = None
    for name, vals in (("year", {m[0] for m in months}), ("month", {m[1] for m in months})):
        known = sorted(v for v in vals if v is not None)
        c = F.col(name).isin(known) if known else F.lit(False)
        if None in vals:
            c = c | F.col(name).isNull()
        cond = c if cond is None else cond & c
    return cond


# The stored fact as read back: contract columns, then the folder columns.
STORED_SCHEMA = T.StructType(FACT_ARRIVALS.schema.fields + [
    T.StructField(c, T.IntegerType(), True) for c in LAYOUT])


def month_folders(fact_path: str, months: list[tuple[int | None, int | None]]) -> list[str]:
    """The ``year=/month=`` folders of ``months`` below the fact's root.

    Reading these paths (with the root as ``basePath``) lists only them, not
    every folder of the fact, which is what a read of the root would do
    before pruning.
    """
    root = fact_path.rstrip("/")

    def v(x):
        return NULL_FOLDER if x is None else str(x)

    return [f"{root}/year={v(y)}/month={v(m)}" for y, m in sorted(set(months), key=str)]


def read_months(spark: SparkSession, fact_path: str,
                months: list[tuple[int | None, int | None]]) -> DataFrame | None:
    """The stored fact rows of ``months`` (with layout columns), or None.

    Only those month folders are read (the null-date folder too when asked
    for); one listing tells which of them exist.
    """
    there = {f"{fact_path.rstrip('/')}/{f}" for f in folders_below(spark, fact_path, len(LAYOUT))}
    folders = [f for f in month_folders(fact_path, months) if f in there]
    if not folders:
        return None
    return (spark.read.schema(STORED_SCHEMA).option("basePath", fact_path)
            .parquet(*folders).filter(_in_months(months)))


def unseen_rows(spark: SparkSession, batch: DataFrame, fact_path: str,
                summary: Summary | None = None) -> DataFrame:
    """The batch's typed, distinct rows (with layout columns) not yet in the fact."""
    new = _with_layout(fact_arrivals(batch.select(*ARRIVAL_COLUMNS)))
    return _unseen(spark, new, fact_path, _summary(new) if summary is None else summary)


def _unseen(spark: SparkSession, new: DataFrame, fact_path: str, summary: Summary) -> DataFrame:
    if not summary or not path_exists(spark, fact_path):
        return new  # an empty batch, or nothing stored yet
    # Only the folders of months this batch touches are read, and within
    # them only row groups whose ids overlap the batch's.
    los = [s[2] for s in summary if s[2] is not None]
    his = [s[3] for s in summary if s[3] is not None]
    ids = _in_ids(min(los) if los else None, max(his) if his else None,
                  any(s[4] for s in summary))
    stored = read_months(spark, fact_path, [(y, m) for y, m, *_ in summary])
    if stored is None:
        return new  # none of these months is stored yet
    stored = stored.filter(ids)
    same = reduce(lambda a, b: a & b,
                  [new[c].eqNullSafe(stored[c]) for c in FACT_ARRIVALS.names + LAYOUT])
    return new.join(stored, same, "left_anti")


def merge_into_fact(spark: SparkSession, batch: DataFrame,
                    fact_path: str) -> list[tuple[int | None, int | None]]:
    """Append the batch's typed rows that the fact does not hold yet.

    Returns the (year, month) folders the batch touches (bounded by the
    calendar), whether or not any of its rows were new.
    """
    complete(spark, fact_path)
    # The typed batch is written once: the summary, the anti join and the
    # append then read it instead of the delivery files.
    kept = scratch_dir(spark, "daily-batch")
    _with_layout(fact_arrivals(batch.select(*ARRIVAL_COLUMNS))).write.parquet(kept)
    new = spark.read.parquet(kept)
    summary = _summary(new)
    write_partitioned(_unseen(spark, new, fact_path, summary), fact_path, LAYOUT,
                      mode="append", cluster_by=FACT_CLUSTER)
    delete_path(spark, kept)
    return [(y, m) for y, m, *_ in summary]


def ingest_deliveries(spark: SparkSession, source: str, fact_path: str, checkpoint: str,
                      fmt: str = "parquet", glob: str | None = "*.parquet",
                      schema: T.StructType = RAW_ARRIVALS,
                      max_files_per_trigger: int | None = None,
                      options: Mapping[str, str] | None = None,
                      after_merge: Callable[[list[tuple[int | None, int | None]]], None]
                      | None = None, merge: str = "rows") -> None:
    """Process every delivery file not seen before, then stop.

    ``merge``: with ``"rows"`` every distinct record is kept, as the batch job
    does; with ``"keys"`` a record replaces the stored one of the same arrival
    id (:mod:`arrivals.streaming.corrections`).

    ``checkpoint`` must be on shared storage and the same in every run (not
    below Spark's checkpoint folder, which is another one in each
    application); it is the record of which files were read.  A format that
    Spark cannot read as a stream is refused; its deliveries need the batch run.
    ``after_merge`` is called in each micro-batch, after its rows were
    merged, with the months the batch touched; it runs again when a batch is
    replayed, so it must be idempotent.
    """
    if merge not in ("rows", "keys"):
        raise ValueError(f"merge must be 'rows' or 'keys', got {merge!r}")
    if not path_exists(spark, source):
        return  # no delivery has arrived yet: nothing to read or merge
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    try:
        stream = reader.load(source)
    except Exception as e:  # each source has its own error for this
        raise ValueError(f"format {fmt!r} cannot be read as a stream: {e}") from e

    if merge == "keys":
        from arrivals.streaming.corrections import upsert_into_fact, with_delivery
        stream = with_delivery(stream)

    def _each(batch: DataFrame) -> None:
        months = (merge_into_fact if merge == "rows" else upsert_into_fact)(spark, batch, fact_path)
        if after_merge is not None and months:
            after_merge(months)

    q = (stream.writeStream
         .foreachBatch(lambda batch, _epoch: _each(batch))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()

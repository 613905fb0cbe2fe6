"""Parquet writes with a folder layout.

A partitioned write must not hand a whole partition value to one task
(one month may hold a third of all arrivals) and must not have every task
write a file into every folder (tasks x folders small files).  The
``rebalance`` hint does both: rows are hash-distributed on the layout
columns, then adaptive execution splits oversized partitions into
advisory-size pieces and merges small ones, so each folder gets files of
about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.session import delete_path, path_exists, rename_path


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the folder ``path`` by what ``write(new_path)`` writes.

    The new files go to a folder beside it, which takes its place only after
    the write has committed; a failed write leaves the old folder as it was.
    """
    path = path.rstrip("/")
    tag = uuid.uuid4().hex[:12]
    new, old = f"{path}.new-{tag}", f"{path}.old-{tag}"
    try:
        write(new)
    except BaseException:
        delete_path(spark, new)
        raise
    if path_exists(spark, path):
        rename_path(spark, path, old)
    try:
        rename_path(spark, new, path)
    except BaseException:
        if path_exists(spark, old):
            rename_path(spark, old, path)
        raise
    delete_path(spark, old)
    spark.catalog.refreshByPath(path)


def balanced_for_layout(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distribute rows so each layout folder gets a few full-size files.

    With adaptive execution on, the ``rebalance`` hint does it (hot values
    split, small ones merged at run time).  Without it, range partitioning
    on the layout columns plus a hash of the whole row: the sampled range
    bounds cut a hot value into several tasks, and each task still covers
    a contiguous run of folders.  The hash is deterministic, so a retried
    task receives the same rows.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", *by)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartitionByRange(*[F.col(f"`{c}`") for c in by], row_hash)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite",
                      cluster_by: Sequence[str] = ()) -> None:
    """Write ``df`` as Parquet with one folder level per column in ``by``.

    The layout columns leave the files (their values live in the folder
    names) and come back as columns when the root is read.  ``cluster_by``
    sorts each file by those columns too: the writer sorts by the layout
    columns anyway, so this only lengthens that sort's key, and it gives
    the Parquet row groups narrow min/max ranges that a pushed-down range
    filter can skip.
    """
    laid = balanced_for_layout(df, by)
    if cluster_by:
        laid = laid.sortWithinPartitions(*by, *cluster_by)
    if mode == "overwrite":
        replace_folder(df.sparkSession, path, lambda to: laid.write.partitionBy(*by).parquet(to))
    else:
        laid.write.mode(mode).partitionBy(*by).parquet(path)


# The fact's files are sorted by the arrival id within each month folder.
FACT_CLUSTER = ["cic_id"]

# Fixed value: the folder name Spark writes for a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def write_fact(fact: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Fact rows in ``year=/month=`` folders of the arrival date."""
    laid = fact.withColumns({"year": F.year("arrival_date"), "month": F.month("arrival_date")})
    write_partitioned(laid, path, ["year", "month"], mode, cluster_by=FACT_CLUSTER)


def write_by_column(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """Folders by one column, which then is no longer in the files."""
    write_partitioned(df, path, [column], mode)


def write_by_copy(df: DataFrame, path: str, column: str, copy: str | None = None,
                  mode: str = "overwrite") -> None:
    """Folders by a copy of ``column``, so the files keep the original."""
    copy = copy or f"partition_{column}"
    if copy not in df.columns:
        df = df.withColumn(copy, F.col(column))
    write_partitioned(df, path, [copy], mode)


def write_overwrite(df: DataFrame, path: str) -> None:
    """Unpartitioned Parquet, replacing what is there."""
    replace_folder(df.sparkSession, path, df.write.parquet)


def write_new(df: DataFrame, path: str) -> None:
    """Unpartitioned Parquet; fails if the path already exists."""
    df.write.mode("errorifexists").parquet(path)

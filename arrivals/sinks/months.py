"""Files of the fact's month folders exchanged: corrections, backfills, compaction.

New files are written beside the month folders, in a folder that readers skip.
A journal then names the files that go; only after it is written do new files
move into their months and old ones go.  A run that dies in between is
completed by the next call (:func:`complete`), so every exchange happens whole
or not at all.  Files that an exchange does not name keep their names.  While
it runs, readers may see a row's old and new file; no row is ever missing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.operators.transforms import ARRIVAL_COLUMNS, fact_arrivals
from arrivals.session import (
    delete_path, files_below, path_exists, read_text, remove_empty_folder, rename_path, replace_text)
from arrivals.sinks.parquet import FACT_CLUSTER, NULL_FOLDER, write_partitioned

LAYOUT = ["year", "month"]

#: Fixed value: the journal's name below the fact's root; readers skip such names.
JOURNAL = "_exchange.json"

Month = tuple[int | None, int | None]

#: Quantiles at which one compaction can cut a month; a month with more small
#: files than would fill so many gets larger ones.
STEPS = 1024


def month_of(path: str) -> Month:
    """The month of a folder or file path below the root."""
    values = [part.partition("=")[2] for part in path.split("/")[:len(LAYOUT)]]
    return tuple(None if v == NULL_FOLDER else int(v) for v in values)


@dataclass(frozen=True)
class StoredFile:
    """A data file of the fact: its folder below the root, name and bytes."""
    folder: str
    name: str
    size: int

    @property
    def path(self) -> str:
        return f"{self.folder}/{self.name}"


def month_folder(month: Month) -> str:
    year, of_year = (NULL_FOLDER if x is None else str(x) for x in month)
    return f"year={year}/month={of_year}"


def stored_files(spark: SparkSession, fact_path: str, folders: Iterable[str] | None = None) -> list[StoredFile]:
    """The fact's data files, of all month folders or of some: one listing."""
    wanted = None if folders is None else set(folders)
    out = []
    for path, size in files_below(spark, fact_path, len(LAYOUT)):
        folder, _, name = path.rpartition("/")
        if name[:1] not in "._" and folder[:1] not in "._" and (wanted is None or folder in wanted):
            out.append(StoredFile(folder, name, size))
    return out


def file_of(path: str) -> str:
    """A file's path below the fact's root, from its full path or URI."""
    return "/".join(path.rsplit("/", len(LAYOUT) + 1)[1:])


def complete(spark: SparkSession, fact_path: str) -> bool:
    """Finish an exchange whose journal is written; whether there was one."""
    root = fact_path.rstrip("/")
    text = read_text(spark, f"{root}/{JOURNAL}")
    if text is None:
        return False
    journal = json.loads(text)
    staged = f"{root}/{journal['staged']}"
    for path, _ in files_below(spark, staged, len(LAYOUT)):
        folder, _, name = path.rpartition("/")
        if name[:1] not in "._":
            rename_path(spark, f"{staged}/{path}", f"{root}/{folder}/{name}")
    for path in journal["gone"]:
        delete_path(spark, f"{root}/{path}")
    for folder in {p.rpartition("/")[0] for p in journal["gone"]}:
        remove_empty_folder(spark, f"{root}/{folder}")
    delete_path(spark, staged)
    delete_path(spark, f"{root}/{JOURNAL}")
    spark.catalog.refreshByPath(root)
    return True


def exchange(spark: SparkSession, rows: DataFrame, fact_path: str, gone: Iterable[str],
             months: Iterable[Month] | None = None, files: dict[Month, int] | None = None,
             cluster_by: Sequence[str] = FACT_CLUSTER) -> None:
    """Replace the files ``gone`` (paths below the root) by ``rows``, which
    carry the layout columns.

    ``months``, where given, are the only ones that rows may lie in; a row of
    another month is an error, and nothing changes.  ``files``: how many are
    written for each month, each a range of ids; by default their size follows
    the session's advisory partition size.
    """
    root = fact_path.rstrip("/")
    complete(spark, root)
    staged = f"_exchange-{uuid.uuid4().hex[:12]}"
    path = f"{root}/{staged}"
    try:
        if files is None:
            write_partitioned(rows, path, LAYOUT, mode="errorifexists", cluster_by=cluster_by)
        else:
            (in_files(spark, rows, files).sortWithinPartitions(*LAYOUT, *FACT_CLUSTER)
             .write.partitionBy(*LAYOUT).parquet(path))
        if months is not None:
            allowed = {month_folder(m) for m in months}
            other = sorted({f.folder for f in stored_files(spark, path)} - allowed)
            if other:
                raise ValueError(f"rows outside the months to replace: {', '.join(other[:5])}")
    except BaseException:
        delete_path(spark, path)
        raise
    replace_text(spark, f"{root}/{JOURNAL}", json.dumps({"staged": staged, "gone": sorted(gone)}))
    complete(spark, root)


def in_files(spark: SparkSession, rows: DataFrame, files: dict[Month, int]) -> DataFrame:
    """``rows`` in one partition for each file to write: a month's ids are cut
    at their approximate quantiles, one row of bounds for each month."""
    several = {m: min(n, STEPS) for m, n in files.items() if n > 1}
    bounds: dict[Month, list[int]] = {}
    if several:
        names = [month_folder(m).replace("year=", "").replace("/month=", "-") for m in several]
        found = (rows.filter(F.concat_ws("-", *LAYOUT).isin(names)).groupBy(*LAYOUT)
                 .agg(F.percentile_approx("cic_id", [i / STEPS for i in range(1, STEPS)], 10_000).alias("at")).collect())
        for r in found:
            n = several[r["year"], r["month"]]
            bounds[r["year"], r["month"]] = sorted({r["at"][i * STEPS // n - 1] for i in range(1, n)} if r["at"] else ())
    table, first = [], 0
    for m in files:
        table.append((*m, first, bounds.get(m, [])))
        first += len(bounds.get(m, [])) + 1
    plan = spark.createDataFrame(table, "y int, m int, first int, bounds array<bigint>")  # one row a month
    file = F.col("first") + F.coalesce(F.size(F.filter("bounds", lambda b: b <= F.col("cic_id"))), F.lit(0))
    laid = rows.join(F.broadcast(plan), rows["year"].eqNullSafe(plan["y"]) & rows["month"].eqNullSafe(plan["m"]))
    return laid.withColumn("file", file).repartitionById(first, "file").select(*rows.columns)


def read_months(spark: SparkSession, path: str, schema: T.StructType, months: Iterable[Month]) -> DataFrame:
    """The stored rows of ``months``; only their folders are listed and read."""
    root = path.rstrip("/")
    complete(spark, root)
    there = sorted({f.folder for f in stored_files(spark, root, map(month_folder, months))})
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in there])


def replace_months(spark: SparkSession, rows: DataFrame, fact_path: str, months: Iterable[Month],
                   cluster_by: Sequence[str] = FACT_CLUSTER) -> None:
    """Make ``rows`` (with layout columns) the content of exactly ``months``;
    a month without rows is emptied, all others keep their files."""
    months = list(months)
    complete(spark, fact_path)
    old = stored_files(spark, fact_path, map(month_folder, months)) if path_exists(spark, fact_path) else []
    exchange(spark, rows, fact_path, [f.path for f in old], months, cluster_by=cluster_by)


def months_between(first: tuple[int, int], last: tuple[int, int]) -> list[Month]:
    at, to = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    return [(m // 12, m % 12 + 1) for m in range(at, to + 1)]


def backfill(spark: SparkSession, raw: DataFrame, fact_path: str, first: tuple[int, int],
             last: tuple[int, int]) -> list[Month]:
    """Rebuild the months from ``first`` to ``last`` from raw deliveries.

    The period's rows of ``raw`` become its content; rows of ``raw`` outside
    the period are left out, and months outside it keep their files.  Running
    it again gives the same rows.
    """
    months = months_between(first, last)
    if not months or not all(1 <= m <= 12 and 1 <= y <= 9998 for y, m in (first, last)):
        raise ValueError(f"no period from {first} to {last}")
    year, month = months[-1]
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    fact = fact_arrivals(raw.select(*ARRIVAL_COLUMNS))
    period = fact.filter((F.col("arrival_date") >= F.lit(dt.date(*months[0], 1))) & (F.col("arrival_date") < F.lit(after)))
    replace_months(spark, with_layout(period), fact_path, months)
    return months


def with_layout(fact: DataFrame) -> DataFrame:
    return fact.withColumns({"year": F.year("arrival_date"), "month": F.month("arrival_date")})


def small_files(files: Iterable[StoredFile], target: int) -> dict[str, list[StoredFile]]:
    """Per month folder the files under half of ``target`` bytes, where packing
    them leaves fewer files."""
    by: dict[str, list[StoredFile]] = {}
    for f in files:
        if 2 * f.size < target:
            by.setdefault(f.folder, []).append(f)
    return {folder: own for folder, own in by.items() if packed(own, target) < len(own)}


def packed(files: Iterable[StoredFile], target: int) -> int:
    """How many files of ``target`` bytes hold these."""
    return max(1, -(-sum(f.size for f in files) // target))


def compact(spark: SparkSession, fact_path: str, target: int = 256 << 20) -> dict[str, int]:
    """Pack the small files that daily appends leave into files of about
    ``target`` bytes; returns how many went, by month folder.

    Only files under half of ``target`` are read and rewritten, and only in
    months where that leaves fewer of them.  The new files hold disjoint
    ranges of ids, in order, so pushed-down id ranges still skip row groups.
    """
    complete(spark, fact_path)
    small = small_files(stored_files(spark, fact_path), target)
    if not small:
        return {}
    root = fact_path.rstrip("/")
    paths = [f.path for own in small.values() for f in own]
    from arrivals.streaming.daily import STORED_SCHEMA
    rows = (spark.read.schema(STORED_SCHEMA).option("basePath", root).parquet(*[f"{root}/{p}" for p in paths]))
    exchange(spark, rows, root, paths, files={month_of(f): packed(own, target) for f, own in small.items()})
    return {folder: len(own) for folder, own in small.items()}

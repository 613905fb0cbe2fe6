"""File and table scans.

All scans are declarative ``DataFrameReader`` calls so Catalyst prunes
columns and pushes filters into the reader.  File discovery is Spark's own
(parallel listing for large folders); nothing is listed on the driver in
Python.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Spark's own file formats.
FILE_FORMATS = ("parquet", "csv", "json", "orc", "text")

# The column that holds a CSV line which does not fit the schema.
MALFORMED = "_malformed"


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty relation with a fixed schema (a typed zero-file scan)."""
    return spark.createDataFrame([], schema)


def scan_files(spark: SparkSession, root: str | Sequence[str], fmt: str = "parquet",
               glob: str | None = None, schema: T.StructType | None = None,
               options: Mapping[str, str] | None = None, allow_empty: bool = False) -> DataFrame:
    """Read every file below ``root`` whose name matches ``glob``.

    One reader over the whole tree (``recursiveFileLookup``) gives one scan
    with one task per file split, instead of one plan per file joined by
    unions.  ``fmt`` is any data source name, so a third-party SAS reader
    plugs in here.  A missing path, or no file that matches, is an error, so
    that a mistyped path cannot empty what is built from it.  Only with
    ``allow_empty`` (and a schema) does a single root without files give the
    empty typed relation; a list of paths must always be complete.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    paths = [root] if isinstance(root, str) else list(root)
    allow_empty = allow_empty and schema is not None and len(paths) == 1
    if not paths:
        raise ValueError("no input path")
    try:
        df = reader.load(paths[0] if len(paths) == 1 else paths)
    except AnalysisException as e:
        if allow_empty and e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return empty_frame(spark, schema)
        raise
    if fmt.lower() in FILE_FORMATS and not allow_empty and not df.inputFiles():
        raise FileNotFoundError(f"no file below {paths} matches {glob or '*'}")
    return df


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             sep: str = ",", header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).

    The header's names must be the schema's, in its order; another header is
    an error instead of a silent mix-up.  Values are taken as written: a
    leading blank stays, as in the source.  Lines that do not fit become
    nulls; :func:`malformed_lines` gives them.
    """
    return (spark.read.schema(schema)
            .option("header", str(header).lower())
            .option("enforceSchema", "false")
            .option("sep", sep)
            .option("mode", "PERMISSIVE")
            .csv(path if isinstance(path, str) else list(path)))


def malformed_lines(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                    sep: str = ",", header: bool = True) -> DataFrame:
    """The lines of a CSV that do not fit the schema, as one text column."""
    wide = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    df = (spark.read.schema(wide).option("header", str(header).lower())
          .option("sep", sep).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", MALFORMED)
          .csv(path if isinstance(path, str) else list(path)))
    # Whether a line fits depends on every column, so none may be pruned: the
    # condition on their hash always holds.
    read_all = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]).between(-(1 << 63), (1 << 63) - 1)
    return df.filter(F.col(MALFORMED).isNotNull() & read_all).select(MALFORMED)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


class _Fields(string.Formatter):
    def get_value(self, key, args, kwargs):  # noqa: D401 - Formatter hook
        if isinstance(key, str) and key not in kwargs:
            raise KeyError(f"path template field '{key}' missing from context")
        return super().get_value(key, args, kwargs)


def render_path(template: str, context: Mapping[str, object]) -> str:
    """Fill ``{name}`` fields of a path from the run context (e.g. ``{ds}``)."""
    return _Fields().vformat(template, (), dict(context))


def scan_templated(spark: SparkSession, base: str, template: str,
                   context: Mapping[str, object], fmt: str = "parquet") -> DataFrame:
    """Read the path a run context selects, e.g. one day's delivery."""
    path = base.rstrip("/") + "/" + render_path(template, context).lstrip("/")
    return spark.read.format(fmt).load(path)


def sql_on_view(df: DataFrame, view: str, query: str) -> DataFrame:
    """Run SQL text against a frame under a session-scoped view name."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(query)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)

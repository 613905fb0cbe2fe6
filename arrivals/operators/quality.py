"""Data-quality checks, table contracts and the check report.

Every check is a Spark aggregate that ends in one row; a report is the
union of those rows, computed in one job.  Only the report itself (one
row per check) reaches the driver, and only in :func:`assert_passed`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.contracts import Contract

REPORT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("actual", T.StringType(), True),
    T.StructField("expected", T.StringType(), True),
    T.StructField("passed", T.BooleanType(), False),
])


class DataQualityError(ValueError):
    """Raised once, after all checks ran, when any check failed."""


# ---- check building blocks (each returns a small DataFrame) -------------

def null_count(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    """``SELECT COUNT(*) FROM t WHERE column IS NULL`` as one row."""
    return df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias(alias))


def duplicate_groups(df: DataFrame, keys: Sequence[str], counted: str | None = None,
                     alias: str = "n") -> DataFrame:
    """Groups of ``keys`` seen more than once (``HAVING count(c) > 1``).

    ``counted`` names the column whose non-null values are counted (SQL
    ``count(col)``); by default every row counts.  Partial counts are
    combined before the shuffle, so a hot key costs one row per task.
    """
    cnt = F.count(F.col(counted)) if counted else F.count(F.lit(1))
    return df.groupBy(*keys).agg(cnt.alias(alias)).filter(F.col(alias) > 1)


def not_null_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: nulls in each NOT NULL column of the contract."""
    cols = [c.name for c in contract.columns if c.not_null]
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def key_duplicates(df: DataFrame, contract: Contract, alias: str = "n") -> DataFrame:
    """Key values of the contract held by more than one row."""
    return duplicate_groups(df, contract.key, alias=alias)


def too_long_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: values longer than the VARCHAR limit, per limited column."""
    cols = [c for c in contract.columns if c.max_len is not None]
    return df.agg(*[F.count_if(F.length(F.col(c.name)) > c.max_len).alias(f"{c.name}_too_long")
                    for c in cols])


def schema_problems(df: DataFrame, contract: Contract) -> list[str]:
    """Column-order and type differences between a frame and a contract."""
    problems = []
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(c.name, c.dtype) for c in contract.columns]
    if [n for n, _ in got] != [n for n, _ in want]:
        problems.append(f"columns {[n for n, _ in got]} != {[n for n, _ in want]}")
    for (gn, gt), (wn, wt) in zip(got, want):
        if gn == wn and gt != wt:
            problems.append(f"{gn}: {gt.simpleString()} != {wt.simpleString()}")
    return problems


# ---- checks and the report ----------------------------------------------

@dataclass(frozen=True)
class Check:
    """A named check: a frame and what its result must be.

    ``kind`` is ``"scalar"`` (the first cell of the result must equal
    ``expected``: as numbers, as booleans, or else as text), ``"empty"`` (the
    frame must have no rows) or ``"filled"`` (it must have some); for the last
    two the report shows how many it has.
    """
    name: str
    table: str
    frame: DataFrame
    kind: str = "scalar"
    expected: object = 0

    def row(self) -> DataFrame:
        if self.kind == "empty":
            actual = self.frame.agg(F.count(F.lit(1)).cast("string").alias("actual"))
            expected = F.lit("0")
            passed = F.col("actual") == expected
        elif self.kind == "filled":
            actual = self.frame.agg(F.count(F.lit(1)).cast("string").alias("actual"))
            expected = F.lit("more than 0")
            passed = F.col("actual") != "0"
        elif self.kind == "scalar":
            first = self.frame.columns[0]
            # The first row only; an empty result gives a null cell.
            cell = self.frame.select(F.col(f"`{first}`").alias("cell")).limit(1).agg(F.first("cell").alias("cell"))
            passed = _same(F.col("cell"), cell.schema["cell"].dataType, self.expected)
            actual = cell.select(F.col("cell").cast("string").alias("actual"), passed.alias("same"))
            expected = F.lit(None if self.expected is None else str(self.expected)).cast("string")
            passed = F.col("same")
        else:
            raise ValueError(f"unknown check kind {self.kind!r}")
        return actual.select(
            F.lit(self.name).alias("check_name"),
            F.lit(self.table).alias("table_name"),
            F.col("actual"),
            expected.alias("expected"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )


def _same(cell: Column, kind: T.DataType, expected: object) -> Column:
    """Whether a cell equals an expected value; numbers of any type compare as
    numbers, booleans as 1 and 0."""
    if expected is None:
        return cell.isNull()
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        number = cell.cast("int") if isinstance(kind, T.BooleanType) else cell
        if isinstance(expected, str) and expected.strip().lower() in ("true", "false"):
            expected = expected.strip().lower() == "true"
        text = str(int(expected)) if isinstance(expected, bool) else str(expected)
        exact = "decimal(38,6)" if not isinstance(kind, (T.FloatType, T.DoubleType)) else "double"
        return F.coalesce(number.try_cast(exact) == F.lit(text).try_cast(exact), F.lit(False))
    return F.coalesce(cell.cast("string") == F.lit(str(expected)), F.lit(False))


def report(checks: Sequence[Check]) -> DataFrame:
    """All checks as one frame (one row each), computed in one job."""
    rows = [c.row() for c in checks]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def assert_passed(rep: DataFrame, log=print) -> list[dict]:
    """Collect the (one row per check) report; raise once if any failed."""
    rows = [r.asDict() for r in rep.collect()]
    failed = [r for r in rows if not r["passed"]]
    for r in failed:
        log(f"check {r['check_name']} on {r['table_name']} failed: "
            f"result {r['actual']!r}, expected {r['expected']!r}")
    if failed:
        raise DataQualityError("Data quality checks failed")
    return rows


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n): how many rows each table has."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def filled_checks(tables: dict[str, DataFrame]) -> list[Check]:
    """One check per table that it has rows: a run that lost its input fails."""
    return [Check(f"{name}_has_rows", name, df, kind="filled") for name, df in tables.items()]


def contract_report(df: DataFrame, contract: Contract, keys: bool = True, rows: bool = False) -> DataFrame:
    """Report rows for every contract check of one table (``keys``: the key
    too; ``rows``: that it has rows, counted in the same scan).

    All column checks (nulls in NOT NULL columns, values over a VARCHAR
    limit) are counted in one aggregate, so the table is scanned once for
    them; the key check is one grouped aggregate.  Same columns as
    :func:`report`.
    """
    counts = {}
    for c in contract.columns:
        if c.not_null:
            counts[f"{contract.name}.{c.name}_not_null"] = F.count_if(F.col(c.name).isNull())
        if c.max_len is not None:
            counts[f"{contract.name}.{c.name}_max_length"] = F.count_if(F.length(c.name) > c.max_len)
    filled = f"{contract.name}_has_rows"
    if rows:
        counts[filled] = F.count(F.lit(1))
    parts = []
    if counts:
        one = df.agg(*[v.cast("bigint").alias(f"c{i}") for i, v in enumerate(counts.values())])
        names = list(counts)
        found = one.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("n"))
            for i, n in enumerate(names)])).alias("r")).select("r.*")
        wants_rows = F.col("check_name") == filled
        parts.append(found.select(
            "check_name", F.lit(contract.name).alias("table_name"),
            F.col("n").cast("string").alias("actual"),
            F.when(wants_rows, "more than 0").otherwise("0").alias("expected"),
            ((F.col("n") > 0) == wants_rows).alias("passed")))
    if keys:
        parts.append(Check(f"{contract.name}.key_unique", contract.name,
                           key_duplicates(df, contract), kind="empty").row())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- metrics from the load itself ------------------------------------------

def metric_names(contract: Contract) -> list[str]:
    return ["rows", *[f"{c.name}.nulls" for c in contract.columns],
            *[f"{c.name}.too_long" for c in contract.columns if c.max_len is not None]]


def load_metrics(contract: Contract) -> list[Column]:
    """Aggregates that a load observes while it writes: rows, nulls of every
    column, texts over their limit.  All are counts, so parts add up."""
    def counted(name: str) -> Column:
        column, _, what = name.rpartition(".")
        if not column:
            return F.count(F.lit(1))
        v = F.col(f"`{column}`")
        return F.count_if(v.isNull() if what == "nulls" else F.length(v) > contract.column(column).max_len)

    return [counted(n).alias(n) for n in metric_names(contract)]


def contract_rows(contract: Contract, metrics: dict[str, int]) -> list[tuple]:
    """The rows of :func:`contract_report` (without the key, with the row
    count) from a load's metrics: no table is read."""
    out = []
    for c in contract.columns:
        if c.not_null:
            out.append((f"{contract.name}.{c.name}_not_null", metrics[f"{c.name}.nulls"]))
        if c.max_len is not None:
            out.append((f"{contract.name}.{c.name}_max_length", metrics[f"{c.name}.too_long"]))
    rows = [(check, contract.name, str(n), "0", n == 0) for check, n in out]
    return [*rows, (f"{contract.name}_has_rows", contract.name, str(metrics["rows"]), "more than 0",
                    metrics["rows"] > 0)]


def as_report(spark, rows: Sequence[tuple]) -> DataFrame:
    """Report rows that are known on the driver as a frame, without a task of
    their own: literals that the planner folds."""
    names = [f.name for f in REPORT_SCHEMA]
    values = ["({})".format(", ".join(_literal(v) for v in row)) for row in rows]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS r({', '.join(names)})").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in REPORT_SCHEMA])


def _literal(v: object) -> str:
    if v is None or isinstance(v, bool):
        return {None: "NULL", True: "TRUE", False: "FALSE"}[v]
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


#: The gating checks of null values: check name, table, column.
NULL_CHECKS = [("fact_null_cic_id", "fact_immigration", "cic_id"),
               ("state_temperature_null_avg", "state_temperature", "avg_temperature")]


def null_rows(metrics: dict[str, dict[str, int]]) -> list[tuple]:
    """Report rows of those null checks whose table has metrics."""
    out = []
    for check, table, column in NULL_CHECKS:
        if table in metrics:
            n = metrics[table][f"{column}.nulls"]
            out.append((check, table, str(n), "0", n == 0))
    return out


def checks_from_specs(spark, specs) -> list[Check]:
    """Checks from ``{"table", "sql", "expected_result"}`` specs.

    The SQL runs in the session (set the current database to the
    warehouse's first).  An expected result of ``''`` or ``None`` means
    "the query returns no rows"; any other value is compared with the first
    cell of the result.  A spec without a name is called by its position.
    """
    out = []
    for i, spec in enumerate(specs):
        sql = spec["sql"].strip().rstrip(";")
        expected = spec.get("expected_result")
        frame = spark.sql(sql)
        name = spec.get("name") or f"check_{i + 1}"
        table = spec.get("table") or ""
        if expected in ("", None):
            out.append(Check(name, table, frame, kind="empty"))
        else:
            out.append(Check(name, table, frame, kind="scalar", expected=expected))
    return out


def reference_checks(fact: DataFrame, state_temperature: DataFrame,
                     country_code: DataFrame) -> list[Check]:
    """The pipeline's three gating checks.

    Null arrival ids, null temperature averages, and (code, country) pairs
    that occur more than once; the last passes when no such pair exists.
    """
    tables = {"fact_immigration": fact, "state_temperature": state_temperature}
    return [Check(check, table, null_count(tables[table], column)) for check, table, column in NULL_CHECKS] + [
        country_duplicates(country_code)]


def country_duplicates(country_code: DataFrame) -> Check:
    return Check("country_code_duplicates", "country_code",
                 duplicate_groups(country_code, ["code", "country"], counted="code"), kind="empty")

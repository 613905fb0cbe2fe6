"""Table contracts: the typed shape every load must meet.

A contract holds the column order and types of a warehouse table, which
columns may not be null, the declared key, and VARCHAR length limits.  The
same object drives ``CREATE TABLE`` DDL, the conforming ``select`` before a
load, and the contract checks in :mod:`arrivals.operators.quality`.

Decisions that differ from the declared DDL (see SURVEY 1.3): the key of
``state_temperature`` is (state, month) and that of ``city_demographics``
is (city, state, race), because rows are per month and per race.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark SQL type names used in DDL and casts.
_SQL = {
    T.LongType: "BIGINT",
    T.IntegerType: "INT",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.StringType: "STRING",
    T.DateType: "DATE",
}


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    not_null: bool = False
    max_len: int | None = None  # VARCHAR(n)

    @property
    def sql_type(self) -> str:
        if self.max_len is not None:
            return f"VARCHAR({self.max_len})"
        return _SQL[type(self.dtype)]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    # Columns that exist only in the file layout (partition folders).
    layout: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, not c.not_null) for c in self.columns])

    def column(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def ddl(self, table: str | None = None, using: str = "parquet",
            location: str | None = None,
            partitions: Sequence[tuple[str, str]] = ()) -> str:
        """``CREATE TABLE IF NOT EXISTS``; ``partitions`` adds (name, SQL type)
        folder columns after the contract's and partitions the table by them."""
        cols = ",\n  ".join([f"`{c.name}` {c.sql_type}" for c in self.columns]
                            + [f"`{n}` {t}" for n, t in partitions])
        part = (" PARTITIONED BY (" + ", ".join(f"`{n}`" for n, _ in partitions) + ")"
                if partitions else "")
        loc = f"\nLOCATION '{location}'" if location else ""
        return (f"CREATE TABLE IF NOT EXISTS {table or self.name} (\n  {cols}\n)"
                f" USING {using}{part}{loc}")

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the contract's columns in order, typed with ``try_cast``.

        A value that does not fit the type becomes null, which the not-null
        check then reports.  A text over its VARCHAR limit fails the load,
        which leaves the table's old rows.
        """
        return df.select(*[conform_col(df[c.name], c.dtype).alias(c.name) for c in self.columns])


    def limited(self, df: DataFrame) -> DataFrame:
        """``df``, failing on a text over its VARCHAR limit as a table load does."""
        def held(c: Col) -> Column:
            v = F.col(f"`{c.name}`")
            if c.max_len is None:
                return v
            says = F.raise_error(F.lit(f"{self.name}.{c.name} exceeds {c.max_len} characters"))
            return F.when(F.length(v) > c.max_len, says.cast("string")).otherwise(v).alias(c.name)
        return df.select(*[held(c) for c in self.columns])


def conform_col(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c.cast("string")
    return c.try_cast(dtype)


L, I, Fl, S, D = T.LongType(), T.IntegerType(), T.FloatType(), T.StringType(), T.DateType()

FACT_ARRIVALS = Contract(
    "fact_immigration",
    (
        Col("cic_id", L, not_null=True),
        Col("born_country", I),
        Col("res_country", I),
        Col("i94_mode", I),
        Col("arr_state", S, max_len=3),
        Col("age", I),
        Col("i94_visa", I),
        Col("birth_year", I),
        Col("gender", S, max_len=1),
        Col("visa_type", S, max_len=3),
        Col("arrival_date", D, not_null=True),
    ),
    key=("cic_id",),
    layout=("year", "month"),
)

CITY_DEMOGRAPHICS = Contract(
    "city_demographics",
    (
        Col("city", S, not_null=True, max_len=256),
        Col("state", S, not_null=True, max_len=256),
        Col("med_age", Fl),
        Col("male_pop", L),
        Col("female_pop", L),
        Col("tot_pop", L),
        Col("num_veterans", L),
        Col("foreign_born", L),
        Col("avg_household", Fl),
        Col("race", S, max_len=256),
        Col("count", L),
    ),
    key=("city", "state", "race"),
    layout=("state_code",),
)

STAGING_STATE_TEMPERATURE = Contract(
    "staging_state_temperature",
    (
        Col("dt", D, not_null=True),
        Col("state", S, not_null=True, max_len=256),
        Col("avg_temp", Fl),
        Col("month", I, not_null=True),
        Col("year", I, not_null=True),
    ),
    key=("dt", "state"),
    layout=("partition_state",),
)

STATE_TEMPERATURE = Contract(
    "state_temperature",
    (
        Col("state", S, not_null=True, max_len=256),
        Col("month", I, not_null=True),
        Col("avg_temperature", Fl),
    ),
    key=("state", "month"),
)

DATE_TIME = Contract(
    "date_time",
    (
        Col("date", D, not_null=True),
        Col("day", I),
        Col("week", I),
        Col("month", S, max_len=20),
        Col("year", I),
        Col("weekday", S, max_len=20),
    ),
    key=("date",),
)

COUNTRY_CODE = Contract(
    "country_code",
    (
        Col("code", I, not_null=True),
        Col("country", S, max_len=256),
    ),
    key=("code",),
)

ALL = (STAGING_STATE_TEMPERATURE, FACT_ARRIVALS, CITY_DEMOGRAPHICS, DATE_TIME,
       COUNTRY_CODE, STATE_TEMPERATURE)
BY_NAME = {c.name: c for c in ALL}

"""Warehouse tables in the session catalog.

The warehouse is a database of Parquet tables made from the contracts.
Loads are whole-table replacements or appends.  A replacement is written to
a new folder, a version of the table; one small file, the manifest, names the
current version of every table, and replacing that file in one step is what
makes versions current, of one table or of several together
(:mod:`arrivals.sinks.release`).  The catalog's tables are then pointed to
them; a run that dies in between is completed by :meth:`Warehouse.recover`.
A load that fails leaves the old rows, and a retried load never leaves a
double copy.  The version before the current one is kept, so that queries
that were reading it can end.
Parquet tables do not enforce NOT NULL or keys, so a load conforms the
frame to the contract first and counts, while it writes, what the contract
checks need; the counts stand in the manifest.  One run at a time may write.

With ``fact_layout`` the fact table is not a copy: it is an external table
partitioned by ``year`` and ``month`` over the fact's Parquet layout
itself, and staging it only registers the layout's folders (a metadata
step that never drops the table).  This is for large facts, where copying the whole fact on every run
would cost a full scan and a full write.  Reads still give the contract's
columns only.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from arrivals import contracts as C
from arrivals.operators.quality import load_metrics, metric_names
from arrivals.session import delete_path, folder_size, folders_below, read_text, replace_text
from arrivals.sinks.parquet import NULL_FOLDER, write_fact
from arrivals.sources.files import render_path

MODES = ("overwrite", "append")

# Fixed value: the file below the database's location that names the current versions.
MANIFEST = "_releases/current.json"

# The folder columns of the fact's layout, with their SQL types.
FACT_LAYOUT_COLUMNS = [("year", "INT"), ("month", "INT")]


def _partition_sql(spec: str) -> str:
    """``year=2016/month=4`` -> ``year=2016, month=4`` (the null folder -> NULL)."""
    out = []
    for part in spec.split("/"):
        col, _, value = part.partition("=")
        if value == NULL_FOLDER:
            value = "NULL"
        elif not value.lstrip("-").isdigit():
            raise ValueError(f"unexpected partition value in {spec!r}")
        out.append(f"`{col}`={value}")
    return ", ".join(out)


def _same_path(a: str, b: str) -> bool:
    def norm(p: str) -> str:
        return (p[len("file:"):] if p.startswith("file:") else p).rstrip("/")
    return norm(a) == norm(b)


def _counts(contract: C.Contract, seen: Observation) -> dict[str, int]:
    """What was observed; nothing, of no rows, is 0."""
    found = seen.get
    return {k: int(found.get(k) or 0) for k in metric_names(contract)}


class Warehouse:
    def __init__(self, spark: SparkSession, database: str = "arrivals",
                 location: str | None = None, fact_layout: str | None = None):
        self.spark = spark
        self.database = database
        self.location = location
        self.fact_layout = fact_layout
        self._lock = threading.RLock()

    def table(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def in_place(self, name: str) -> bool:
        """Whether ``name`` is registered over its layout instead of copied."""
        return self.fact_layout is not None and name == C.FACT_ARRIVALS.name

    def _ddl(self, c: C.Contract) -> str:
        if self.in_place(c.name):
            return c.ddl(self.table(c.name), location=self.fact_layout,
                         partitions=FACT_LAYOUT_COLUMNS)
        return c.ddl(self.table(c.name))

    def create_tables(self, contracts: Sequence[C.Contract] = C.ALL) -> list[str]:
        """``CREATE TABLE IF NOT EXISTS`` for every contract; idempotent."""
        loc = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{loc}")
        for c in contracts:
            self.spark.sql(self._ddl(c))
        self.recover()
        return [self.table(c.name) for c in contracts]

    def read(self, name: str) -> DataFrame:
        """The table's rows in the contract's columns (layout columns left out)."""
        df = self.spark.table(self.table(name))
        contract = C.BY_NAME.get(name)
        return df.select(*[f"`{n}`" for n in contract.names]) if contract else df

    def register(self, name: str) -> DataFrame:
        """Make an in-place table mirror its layout folder: a metadata step.

        The table is created when missing and never dropped, so readers
        always find it.  Its partitions are found from the folder names
        (Spark's own listing, parallel for many folders), and partitions
        whose folders a rewrite removed are dropped; the partition list is
        bounded by the calendar and compared with one listing.  Dropping
        a partition of an external table keeps its files.
        """
        if not self.in_place(name):
            raise ValueError(f"{name} is not registered in place")
        t = self.table(name)
        if self.spark.catalog.tableExists(t):
            kind = self.spark.sql(f"DESCRIBE TABLE EXTENDED {t}").filter("col_name = 'Type'").first()
            if kind is None or kind.data_type.strip().upper() != "EXTERNAL":
                raise ValueError(f"{t} exists as a copied table; use another database for in-place")
        else:
            self.create_tables([C.BY_NAME[name]])
        self.spark.sql(f"ALTER TABLE {t} RECOVER PARTITIONS")
        there = folders_below(self.spark, self.fact_layout, len(FACT_LAYOUT_COLUMNS))
        for (spec,) in self.spark.sql(f"SHOW PARTITIONS {t}").collect():
            if spec not in there:
                self.spark.sql(f"ALTER TABLE {t} DROP IF EXISTS PARTITION ({_partition_sql(spec)})")
        self.spark.sql(f"REFRESH TABLE {t}")
        return self.read(name)

    def load(self, name: str, df: DataFrame, mode: str) -> DataFrame:
        """Conform ``df`` to the table's contract and load it.

        ``mode`` must be given: ``"overwrite"`` replaces the contents,
        ``"append"`` adds to them.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        contract = C.BY_NAME[name]
        if self.in_place(name):
            # The table is the layout: write there, then register the folders.
            write_fact(contract.limited(contract.conform(df)), self.fact_layout, mode)
            return self.register(name)
        if mode == "append":
            self._append(name, contract.conform(df))
        else:
            self._replace(name, lambda path: self.write_version(name, df, path))
        return self.read(name)

    # ---- versions and the manifest -----------------------------------------

    def _home(self) -> str:
        return self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")

    def manifest(self) -> dict[str, dict]:
        """Per table: ``location`` of its current version, ``previous`` one,
        and, where they are known, ``metrics`` with the ``size`` they hold for."""
        text = read_text(self.spark, f"{self._home()}/{MANIFEST}")
        return json.loads(text)["tables"] if text else {}

    def _write_manifest(self, tables: dict[str, dict]) -> None:
        replace_text(self.spark, f"{self._home()}/{MANIFEST}", json.dumps({"tables": tables}, indent=1))

    def table_location(self, name: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(name)}").filter("col_name = 'Location'")
        return rows.first().data_type.rstrip("/")

    def new_version(self, name: str) -> str:
        return f"{self._home()}/{name}.v-{uuid.uuid4().hex[:12]}"

    def write_version(self, name: str, df: DataFrame, path: str) -> dict[str, int]:
        """Write ``df`` as a version of a table; returns the metrics the write
        itself observed.  The observation stands right below the write, so a
        task that runs twice counts once."""
        contract = C.BY_NAME[name]
        seen = Observation()
        rows = contract.conform(df).observe(seen, *load_metrics(contract))
        contract.limited(rows).write.parquet(path)
        return _counts(contract, seen)

    def switch(self, versions: Mapping[str, tuple[str, dict[str, int] | None]]) -> None:
        """Make versions (table -> path, metrics) current, all in one step: the
        manifest is replaced, then the catalog follows."""
        with self._lock:
            tables = self.manifest()
            gone = []
            for name, (path, metrics) in versions.items():
                before = tables.get(name, {})
                old = before.get("location") or self.table_location(name)
                gone += [before["previous"]] if before.get("previous") else []
                tables[name] = {"location": path, "previous": old}
                if metrics is not None:
                    tables[name] |= {"metrics": metrics, "size": folder_size(self.spark, path)}
            self._write_manifest(tables)
            for name, (path, _) in versions.items():
                self._point(name, path)
            for path in gone:
                delete_path(self.spark, path)

    def _point(self, name: str, path: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.table(name)} SET LOCATION '{path}'")
        self.spark.sql(f"REFRESH TABLE {self.table(name)}")

    def recover(self) -> list[str]:
        """Point the catalog's tables to what the manifest names, which a run
        that died in a switch may have left undone; returns the names moved."""
        moved = []
        with self._lock:
            for name, entry in self.manifest().items():
                if self.spark.catalog.tableExists(self.table(name)) and \
                        not _same_path(self.table_location(name), entry["location"]):
                    self._point(name, entry["location"])
                    moved.append(name)
        return moved

    def metrics(self) -> dict[str, dict[str, int]]:
        """What loads have observed of the tables' current rows, for the tables
        whose files are still those of the loads (one listing each)."""
        return {name: entry["metrics"] for name, entry in self.manifest().items() if "metrics" in entry
                and not self.in_place(name)
                and tuple(entry["size"]) == folder_size(self.spark, entry["location"])}

    def _append(self, name: str, rows: DataFrame) -> None:
        """Append; counts add up.  While it runs, the manifest has no counts."""
        contract = C.BY_NAME[name]
        with self._lock:
            known = self.metrics().get(name)
            tables = self.manifest()
            if "metrics" in tables.get(name, {}):
                self._write_manifest(tables | {name: {k: v for k, v in tables[name].items()
                                                      if k not in ("metrics", "size")}})
            seen = Observation()
            rows.observe(seen, *load_metrics(contract)).write.insertInto(self.table(name))
            if known is not None:
                added = {k: known[k] + v for k, v in _counts(contract, seen).items()}
                size = folder_size(self.spark, tables[name]["location"])
                self._write_manifest(tables | {name: tables[name] | {"metrics": added, "size": size}})

    def _replace(self, name: str, write: Callable[[str], dict[str, int] | None]) -> None:
        """Write a new version of one table and make it current."""
        path = self.new_version(name)
        try:
            metrics = write(path)
        except BaseException:
            delete_path(self.spark, path)
            raise
        self.switch({name: (path, metrics)})

    def stage(self, name: str, base: str, key_template: str,
              context: Mapping[str, object] | None = None) -> DataFrame:
        """Replace a table with the Parquet files under ``base/key``.

        The key may hold ``{field}`` templates filled from ``context`` (for
        instance a run date).  Only the contract's columns are loaded:
        layout columns read back from folder names are dropped.
        """
        path = base.rstrip("/") + "/" + render_path(key_template, context or {}).lstrip("/")
        if self.in_place(name) and _same_path(path, self.fact_layout):
            return self.register(name)
        return self.load(name, self.spark.read.parquet(path), "overwrite")

    def insert_select(self, name: str, columns: Sequence[str], select_sql: str,
                      mode: str, args: Mapping[str, object] | None = None) -> DataFrame:
        """``INSERT INTO t (cols) <select>`` with the name bound safely; with
        ``"overwrite"`` into a new version that then replaces the rows."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        cols = ", ".join(f"`{c}`" for c in columns)

        def insert(table: str) -> None:
            self.spark.sql(f"INSERT INTO IDENTIFIER(:t) ({cols}) {select_sql}", args={"t": table, **(args or {})})

        def insert_version(path: str) -> None:
            version = f"{name}_v_{uuid.uuid4().hex[:12]}"
            self.spark.sql(C.BY_NAME[name].ddl(self.table(version), location=path))
            try:
                insert(f"{self.database}.{version}")
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.table(version)}")

        if mode == "append":
            insert(f"{self.database}.{name}")
        else:
            self._replace(name, insert_version)
        return self.read(name)

"""Write, audit, publish: the tables of a run become current together.

A release writes new versions of tables beside the current ones.  Nothing a
reader of the warehouse sees changes until :meth:`Release.publish`, which
replaces the warehouse's manifest once for all of them.  The audit in between
takes its counts from the writes themselves (``DataFrame.observe``); only the
key checks read a table again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from arrivals import contracts as C
from arrivals.operators import quality as Q
from arrivals.session import delete_path
from arrivals.sinks.tables import Warehouse, _same_path
from arrivals.sources.files import render_path


def report_of(read, metrics: Mapping[str, Mapping[str, int]], spark, contracts: bool = False,
              tables=C.ALL) -> DataFrame:
    """The gating checks over ``read(name)`` of each table: counts come from
    ``metrics`` where a load has observed them, else from a scan; keys from the
    tables.  ``contracts`` adds the declared keys of all tables."""
    names = {c.name for c in tables}
    known = {n: m for n, m in metrics.items() if n in names}

    def counted(rows: list[tuple]) -> list[DataFrame]:
        return [Q.as_report(spark, rows)] if rows else []

    checks = [Q.Check(check, table, Q.null_count(read(table), column)) for check, table, column in Q.NULL_CHECKS
              if table in names and table not in known]
    if "country_code" in names:
        checks.append(Q.country_duplicates(read("country_code")))
    frames = counted(Q.null_rows(known)) + ([Q.report(checks)] if checks else [])
    frames += counted([row for c in tables if c.name in known for row in Q.contract_rows(c, known[c.name])])
    keys = []
    for c in tables:
        if c.name not in known:
            frames.append(Q.contract_report(read(c.name), c, keys=contracts, rows=True))
        elif contracts:
            keys.append(Q.Check(f"{c.name}.key_unique", c.name, Q.key_duplicates(read(c.name), c), kind="empty"))
    out = frames[0]
    for f in frames[1:] + ([Q.report(keys)] if keys else []):
        out = out.unionByName(f)
    return out


class Release:
    """New versions of a warehouse's tables that are not current yet.

    Tables that are in place over their layout have no versions: staging them
    registers the layout, as without a release.
    """

    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.versions: dict[str, tuple[str, dict[str, int]]] = {}

    def load(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as the release's version of a table."""
        if self.wh.in_place(name):
            return self.wh.load(name, df, "overwrite")
        path = self.wh.new_version(name)
        try:
            metrics = self.wh.write_version(name, df, path)
        except BaseException:
            delete_path(self.wh.spark, path)
            raise
        before = self.versions.get(name)
        self.versions[name] = (path, metrics)
        if before:
            delete_path(self.wh.spark, before[0])
        return self.read(name)

    def stage(self, name: str, base: str, key_template: str,
              context: Mapping[str, object] | None = None) -> DataFrame:
        """The Parquet files under ``base/key`` as the release's version."""
        path = base.rstrip("/") + "/" + render_path(key_template, context or {}).lstrip("/")
        if self.wh.in_place(name) and _same_path(path, self.wh.fact_layout):
            return self.wh.register(name)
        return self.load(name, self.wh.spark.read.parquet(path))

    def read(self, name: str) -> DataFrame:
        """The release's version of a table, else its current rows."""
        if name not in self.versions:
            return self.wh.read(name)
        return self.wh.spark.read.schema(C.BY_NAME[name].schema).parquet(self.versions[name][0])

    def report(self, contracts: bool = False) -> DataFrame:
        """The gating checks of the tables as they would be once published."""
        known = self.wh.metrics() | {n: m for n, (_, m) in self.versions.items()}
        return report_of(self.read, known, self.wh.spark, contracts)

    def publish(self) -> None:
        """Make all versions current, in one step."""
        if self.versions:
            self.wh.switch(self.versions)
        self.versions = {}

    def discard(self) -> None:
        """Delete the versions; the warehouse stays as it was."""
        for path, _ in self.versions.values():
            delete_path(self.wh.spark, path)
        self.versions = {}

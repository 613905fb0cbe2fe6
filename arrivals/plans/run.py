"""Command line for scheduled runs, driven by an INI file.

    python -m arrivals -c arrivals.cfg layout     # raw files -> Parquet layout
    python -m arrivals -c arrivals.cfg warehouse  # create tables, load them, two dimensions
    python -m arrivals -c arrivals.cfg check      # the gating checks
    python -m arrivals -c arrivals.cfg all        # the three above, in order
    python -m arrivals -c arrivals.cfg daily      # only delivery files not read before
    python -m arrivals -c arrivals.cfg backfill   # rebuild the months of a period from the arrivals input
    python -m arrivals -c arrivals.cfg compact    # pack the small files that daily runs leave

A scheduler (cron or any workflow tool) runs these commands; the exit status
is the task's outcome: 0 done, 1 a data-quality check failed, 2 bad usage or
configuration.  ``--set section.key=value`` overrides the file, for instance
a per-run output folder.  ``--context key=value`` fills ``{key}`` fields of
the input and output paths (for instance ``{ds}``, the run date), so a
backfill is the same command with another context.  Every command is a thin
driver over the library's Spark jobs; the report of ``check`` (one row per
check) is the only result that comes back to the driver, and it is printed
as JSON lines, failed checks included.

Storage credentials are not read here: the cluster's own Hadoop
configuration supplies them.

Example file::

    [inputs]
    arrivals = s3a://bucket/raw/arrivals
    arrivals_format = parquet
    arrivals_glob = *.parquet
    demographics = s3a://bucket/raw/us-cities-demographics.csv
    temperature = s3a://bucket/raw/temperature-by-state.csv
    country_code = s3a://bucket/raw/country_code.csv

    [output]
    layout = s3a://bucket/layout

    [warehouse]
    database = arrivals
    location = s3a://bucket/warehouse
    fact_in_place = true

    [run]
    years = 10
    parallel = true
    contracts = false
    daily_max_files = 1000
    checks_file = /etc/arrivals/checks.json

With ``fact_in_place`` the warehouse's fact table is registered over the
fact's Parquet layout (partitioned by year and month) instead of being
copied on each ``warehouse`` run, and ``daily`` makes new rows visible in it
at once and adds their new dates to ``date_time``.  Use a database of its own
for that mode.

``all`` writes new versions of all tables, audits them and makes them current
together; a failed check leaves every table as it was.  ``daily_merge = keys``
merges deliveries by arrival id (a later record replaces an earlier one)
instead of keeping every distinct record.  ``backfill`` replaces exactly the
months from ``backfill_first`` to ``backfill_last`` (``YYYY-MM``); ``compact``
packs files under half of ``compact_bytes``.  ``travel_counts`` names a folder
where ``daily`` and ``backfill`` keep arrivals per state and month.

``checks_file`` (optional, a local file read on the driver like this one)
holds more checks in the form ``[{"table": ..., "sql": ...,
"expected_result": ...}, ...]``; their SQL names warehouse tables without the
database.  An expected result of ``""`` means "no rows".
"""

from __future__ import annotations

import argparse
import configparser
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from arrivals.operators import quality as Q
from arrivals.plans import pipeline as P
from arrivals.session import build_session
from arrivals.sinks import months as MO
from arrivals.sinks.tables import Warehouse
from arrivals.sources.files import render_path
from arrivals.streaming import daily as DY
from arrivals.streaming import maintained as MA

COMMANDS = ("layout", "warehouse", "check", "all", "daily", "backfill", "compact")

# Defaults for keys a file may leave out.
DEFAULTS = {
    "inputs": {"arrivals_format": "parquet", "arrivals_glob": "*.parquet"},
    "warehouse": {"database": "arrivals", "location": "", "fact_in_place": "false"},
    "run": {"years": "10", "parallel": "true", "contracts": "false", "resume": "false",
            "daily_checkpoint": "", "daily_max_files": "", "daily_merge": "rows",
            "compact_bytes": str(256 << 20), "checks_file": ""},
}


# The settings that are paths and take ``{field}`` templates.
TEMPLATED = [("inputs", "arrivals"), ("inputs", "demographics"), ("inputs", "temperature"),
             ("inputs", "country_code"), ("output", "layout")]


class ConfigError(ValueError):
    """A missing or malformed setting."""


def load_config(path: str | None, overrides: Sequence[str] = (),
                context: Sequence[str] = ()) -> configparser.ConfigParser:
    cfg = configparser.ConfigParser(interpolation=None)
    cfg.read_dict(DEFAULTS)
    if path:
        with open(path, encoding="utf-8") as fh:
            cfg.read_file(fh)
    for item in overrides:
        key, sep, value = item.partition("=")
        section, dot, option = key.partition(".")
        if not sep or not dot or not section or not option:
            raise ConfigError(f"--set wants section.key=value, got {item!r}")
        if not cfg.has_section(section):
            cfg.add_section(section)
        cfg.set(section, option, value)
    fields = {}
    for item in context:
        key, sep, value = item.partition("=")
        if not sep or not key:
            raise ConfigError(f"--context wants key=value, got {item!r}")
        fields[key] = value
    if fields:
        for section, option in TEMPLATED:
            value = cfg.get(section, option, fallback="")
            try:
                cfg.set(section, option, render_path(value, fields))
            except (KeyError, ValueError, IndexError) as e:
                raise ConfigError(f"[{section}] {option} = {value!r}: {e}") from None
    return cfg


def _get(cfg: configparser.ConfigParser, section: str, option: str) -> str:
    value = cfg.get(section, option, fallback="").strip()
    if not value:
        raise ConfigError(f"setting [{section}] {option} is missing")
    return value


def _flag(cfg: configparser.ConfigParser, section: str, option: str) -> bool:
    try:
        return cfg.getboolean(section, option)
    except ValueError as e:
        raise ConfigError(f"[{section}] {option}: {e}") from None


def inputs_of(cfg: configparser.ConfigParser) -> P.Inputs:
    glob = cfg.get("inputs", "arrivals_glob", fallback="").strip() or None
    options = {k[len("arrivals_option."):]: v for k, v in cfg.items("inputs")
               if k.startswith("arrivals_option.")}
    return P.Inputs(
        arrivals=_get(cfg, "inputs", "arrivals"),
        demographics=_get(cfg, "inputs", "demographics"),
        temperature=_get(cfg, "inputs", "temperature"),
        country_code=_get(cfg, "inputs", "country_code"),
        arrivals_format=_get(cfg, "inputs", "arrivals_format"),
        arrivals_glob=glob,
        arrivals_options=options,
    )


def warehouse_of(spark: SparkSession, cfg: configparser.ConfigParser, layout: str = "") -> Warehouse:
    location = cfg.get("warehouse", "location", fallback="").strip() or None
    fact_layout = (P.fact_path(layout)
                   if layout and _flag(cfg, "warehouse", "fact_in_place") else None)
    return Warehouse(spark, _get(cfg, "warehouse", "database"), location=location,
                     fact_layout=fact_layout)


def _years(cfg: configparser.ConfigParser) -> int:
    try:
        years = cfg.getint("run", "years")
    except ValueError as e:
        raise ConfigError(f"[run] years: {e}") from None
    if years < 1:
        raise ConfigError("[run] years must be at least 1")
    return years


def _month(cfg: configparser.ConfigParser, option: str) -> tuple[int, int]:
    text = _get(cfg, "run", option)
    year, _, month = text.partition("-")
    if not (year.isdigit() and month.isdigit() and 1 <= int(month) <= 12):
        raise ConfigError(f"[run] {option} wants YYYY-MM, got {text!r}")
    return int(year), int(month)


def run_command(spark: SparkSession, command: str, cfg: configparser.ConfigParser,
                out=None) -> int:
    """Run one command; return the exit status."""
    out = out or sys.stdout
    if command not in COMMANDS:
        raise ConfigError(f"unknown command {command!r}; one of {COMMANDS}")
    layout = _get(cfg, "output", "layout") if command != "check" else ""
    years = _years(cfg)
    parallel = _flag(cfg, "run", "parallel")

    if command in ("layout", "all"):
        P.build_layout(spark, inputs_of(cfg), layout, years, parallel,
                       resume=_flag(cfg, "run", "resume"))
    if command == "daily":
        # The file-source checkpoint must stay at one place between runs, in
        # whatever application; by default it lies beside the fact's layout.
        ckpt = (cfg.get("run", "daily_checkpoint", fallback="").strip()
                or layout.rstrip("/") + "/_daily_sources")
        # A bound on files per micro-batch turns a long backlog (a first run
        # over the whole history) into batches that each commit on their own,
        # so a failure restarts after the last committed batch.
        max_files = cfg.get("run", "daily_max_files", fallback="").strip()
        if max_files and not (max_files.isdigit() and int(max_files) > 0):
            raise ConfigError("[run] daily_max_files must be a positive integer")
        merge = _get(cfg, "run", "daily_merge")
        if merge not in ("rows", "keys"):
            raise ConfigError("[run] daily_merge must be rows or keys")
        inp = inputs_of(cfg)
        wh = warehouse_of(spark, cfg, layout)
        live = wh.in_place("fact_immigration") and spark.catalog.tableExists(
            wh.table("fact_immigration"))
        # With the fact in place, each micro-batch also adds its new dates to
        # the date dimension (only its months are read; replay-safe).
        after = None
        if live and spark.catalog.tableExists(wh.table("date_time")):
            def after(months):
                P.add_new_dates(wh, P.fact_path(layout), months)
        # Arrivals per state and month, kept for the analyses: the touched months are recounted.
        counts = cfg.get("run", "travel_counts", fallback="").strip()
        add_dates = after
        if counts:
            def after(months):
                if add_dates is not None:
                    add_dates(months)
                MA.refresh_travel_counts(spark, P.fact_path(layout), counts, months)
        DY.ingest_deliveries(spark, inp.arrivals, P.fact_path(layout), ckpt,
                             fmt=inp.arrivals_format, glob=inp.arrivals_glob,
                             max_files_per_trigger=int(max_files) if max_files else None,
                             options=inp.arrivals_options, after_merge=after, merge=merge)
        if live:
            wh.register("fact_immigration")  # new months and files, no copy
    if command in ("backfill", "compact"):
        path = P.fact_path(layout)
        if command == "backfill":
            months = MO.backfill(spark, P.read_arrivals(spark, inputs_of(cfg)), path, *(
                _month(cfg, option) for option in ("backfill_first", "backfill_last")))
            if counts := cfg.get("run", "travel_counts", fallback="").strip():
                MA.refresh_travel_counts(spark, path, counts, months)
        else:
            size = _get(cfg, "run", "compact_bytes")
            if not size.isdigit() or not int(size):
                raise ConfigError("[run] compact_bytes must be a positive integer")
            for folder, n in MO.compact(spark, path, int(size)).items():
                print(json.dumps({"folder": folder, "files_packed": n}), file=out)
        wh = warehouse_of(spark, cfg, layout)
        if wh.in_place("fact_immigration") and spark.catalog.tableExists(wh.table("fact_immigration")):
            wh.register("fact_immigration")
    if command == "warehouse":
        P.load_warehouse(spark, warehouse_of(spark, cfg, layout), layout, years, parallel)
    if command in ("check", "all"):
        # The whole report (one row per check) is printed, failed or not.
        if command == "all":
            # Written, audited, and only then made current: all tables or none.
            new = P.write_release(spark, warehouse_of(spark, cfg, layout), layout, years, parallel)
            rows = [r.asDict() for r in new.report(_flag(cfg, "run", "contracts")).collect()]
            if all(r["passed"] for r in rows):
                new.publish()
                rows += _checked(spark, cfg, own=False)
            else:
                new.discard()
        else:
            rows = _checked(spark, cfg)
        for r in rows:
            print(json.dumps(r, default=str), file=out)
        failed = [r for r in rows if not r["passed"]]
        for r in failed:
            print(f"check {r['check_name']} on {r['table_name']} failed: "
                  f"result {r['actual']!r}, expected {r['expected']!r}", file=sys.stderr)
        if failed:
            print("Data quality checks failed", file=sys.stderr)
            return 1
    return 0


def load_specs(path: str) -> list[dict]:
    """The check specs of a JSON file: a list of ``{table, sql, expected_result}``."""
    with open(path, encoding="utf-8") as fh:
        specs = json.load(fh)
    if not isinstance(specs, list) or not all(isinstance(s, dict) and "sql" in s for s in specs):
        raise ConfigError(f"{path}: want a JSON list of objects with 'sql'")
    return specs


def _checked(spark: SparkSession, cfg: configparser.ConfigParser, own: bool = True) -> list[dict]:
    """The report rows of the gating checks (``own``) and of the file's checks."""
    wh = warehouse_of(spark, cfg)
    reports = [P.quality_report(wh, _flag(cfg, "run", "contracts"))] if own else []
    specs_path = cfg.get("run", "checks_file", fallback="").strip()
    # Unqualified table names in the specs resolve in the warehouse database.
    previous = spark.catalog.currentDatabase()
    try:
        if specs_path:
            spark.catalog.setCurrentDatabase(wh.database)
            reports.append(Q.report(Q.checks_from_specs(spark, load_specs(specs_path))))
        return [r.asDict() for rep in reports for r in rep.collect()]
    finally:
        spark.catalog.setCurrentDatabase(previous)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m arrivals", description=__doc__.split("\n")[0])
    ap.add_argument("command", choices=COMMANDS)
    ap.add_argument("-c", "--config", help="INI file with [inputs], [output], [warehouse], [run]")
    ap.add_argument("--set", action="append", default=[], metavar="SECTION.KEY=VALUE",
                    help="override one setting (repeatable)")
    ap.add_argument("--context", action="append", default=[], metavar="KEY=VALUE",
                    help="fill {KEY} in the input and output paths (repeatable)")
    ap.add_argument("--master", help="Spark master when not given by spark-submit")
    args = ap.parse_args(argv)
    try:
        cfg = load_config(args.config, args.set, args.context)
        session = spark or build_session(args.master)
        return run_command(session, args.command, cfg)
    except (ConfigError, OSError, json.JSONDecodeError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2

"""Write PLANS.md: the formatted physical plans of the headline jobs.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arrivals.operators import analytics as A  # noqa: E402
from arrivals.operators import quality as Q  # noqa: E402
from arrivals.operators import transforms as J  # noqa: E402
from arrivals import contracts as C  # noqa: E402
from arrivals.functions.dates import sas_date  # noqa: E402
from arrivals.plans import pipeline as P  # noqa: E402
from arrivals.session import build_session, scratch_dir  # noqa: E402
from arrivals.sinks import parquet as K  # noqa: E402
from arrivals.sources import fixtures as FX  # noqa: E402
from arrivals.sources import raw as R  # noqa: E402
from arrivals.sources.files import read_csv  # noqa: E402
from arrivals.streaming import daily as DY  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    root = scratch_dir(spark, "plans")
    paths = FX.write_raw_inputs(spark, sf, f"{root}/raw")
    inp = P.Inputs.of(paths)
    fact = J.fact_arrivals(P.read_arrivals(spark, inp))
    K.write_fact(fact, f"{root}/fact")
    stored = spark.read.parquet(f"{root}/fact").select(*C.FACT_ARRIVALS.names)
    city = J.city_demographics(read_csv(spark, inp.demographics, R.RAW_DEMOGRAPHICS, sep=";"))
    staging = J.state_temperature_staging(read_csv(spark, inp.temperature, R.RAW_TEMPERATURE), 10)
    # As in the pipeline, the dimension reads the staged rows, not their lineage.
    K.write_by_copy(staging, f"{root}/staging", "state", "partition_state")
    staged = spark.read.parquet(f"{root}/staging").select(*C.STAGING_STATE_TEMPERATURE.names)
    dim = J.state_temperature_dim(staged, 10)
    laid = fact.withColumns({"year": F.year("arrival_date"), "month": F.month("arrival_date")})
    # one month of deliveries arriving again, against the stored fact
    batch = P.read_arrivals(spark, inp)
    first = batch.select(F.min(sas_date("arrdate"))).first()[0]
    batch = batch.filter(sas_date("arrdate") < F.add_months(F.lit(first), 1))
    # The stored date dimension, as the daily update sees it.
    J.date_dim(stored).write.parquet(f"{root}/dates")
    known_dates = spark.read.parquet(f"{root}/dates").select("date")
    plans = [
        ("J1 fact from delivery files", fact),
        ("K1 fact layout write input (rebalanced)", K.balanced_for_layout(laid, ["year", "month"])),
        ("J3 state temperature staging (recent-years window)", staging),
        ("J5 state temperature dimension", dim),
        ("J6 date dimension from the stored fact", J.date_dim(stored)),
        ("D1 travel by state and month", A.travel_by_state_month(stored)),
        ("D2 correlation with demographics", A.corr_travel_demographics(stored, city)),
        ("D3 correlation with temperature", A.corr_travel_temperature(stored, A.state_bridge(city), dim)),
        ("Contract report of the fact (one pass + key check)", Q.contract_report(stored, C.FACT_ARRIVALS)),
        ("Incremental merge: batch rows not yet stored (month- and id-range-pruned read)",
         DY.unseen_rows(spark, batch, f"{root}/fact")),
        ("Daily date dimension update: dates of the touched months only, not yet known",
         J.date_dim(DY.read_months(spark, f"{root}/fact", DY.touched_months(batch)))
         .join(known_dates, "date", "left_anti")),
    ]
    out = ["# PLANS", "",
           f"Formatted physical plans (before adaptive re-planning) on `{sf}`, made by",
           "`tools/explain_plans.py`. Look for `ReadSchema` (column pruning),",
           "`PushedFilters`, and the number of `Exchange` nodes. The recent-years",
           "window is one scalar subquery (`max(year) - N`); Parquet scans list it",
           "as `GreaterThan(year,ScalarSubquery...)` in `PushedFilters`, and its",
           "value is filled in at run time.", ""]
    for title, df in plans:
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: the pipeline step by step, then the three analyses.

Raw inputs are derived from the driver's tables at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) and written once, untimed, in the raw
shapes (monthly Parquet deliveries of arrivals, written twice; ';' and ','
CSV for the rest).  Each timed step is one of the pipeline's jobs, run in
dependency order; analyses read the loaded warehouse tables.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arrivals import contracts as C  # noqa: E402
from arrivals.operators import analytics as A  # noqa: E402
from arrivals.operators import quality as Q  # noqa: E402
from arrivals.operators import transforms as J  # noqa: E402
from arrivals.plans import pipeline as P  # noqa: E402
from arrivals.session import build_session, scratch_dir  # noqa: E402
from arrivals.sinks import parquet as K  # noqa: E402
from arrivals.sinks.tables import Warehouse  # noqa: E402
from arrivals.sources import fixtures as FX  # noqa: E402
from arrivals.sources import raw as R  # noqa: E402
from arrivals.sources.files import read_csv  # noqa: E402
from arrivals.streaming import daily as DY  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="arrivals-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    root = scratch_dir(spark, "bench")
    paths = FX.write_raw_inputs(spark, sf_dir, f"{root}/raw")
    inp = P.Inputs.of(paths)
    out = f"{root}/layout"
    wh = Warehouse(spark, "bench_wh", location=f"{root}/warehouse")
    years = 10
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    timed("j1_fact_arrivals", lambda: K.write_fact(J.fact_arrivals(P.read_arrivals(spark, inp)),
                                                   f"{out}/{P.FACT_KEY}"))
    timed("j2_city_demographics", lambda: K.write_by_column(
        J.city_demographics(read_csv(spark, inp.demographics, R.RAW_DEMOGRAPHICS, sep=";")),
        f"{out}/{P.CITY_KEY}", "state_code"))
    timed("j3_state_temperature_staging", lambda: K.write_by_copy(
        P.staged_temperature(read_csv(spark, inp.temperature, R.RAW_TEMPERATURE), years),
        f"{out}/{P.STATE_TEMP_KEY}", "state", "partition_state"))
    timed("j4_country_code", lambda: K.write_overwrite(
        J.country_codes(read_csv(spark, inp.country_code, R.RAW_COUNTRY_CODES)),
        f"{out}/{P.COUNTRY_KEY}"))

    def stage_all():
        wh.create_tables()
        for name, key in [("fact_immigration", P.FACT_KEY), ("staging_state_temperature", P.STATE_TEMP_KEY),
                          ("city_demographics", P.CITY_KEY), ("country_code", P.COUNTRY_KEY)]:
            wh.stage(name, out, key)

    timed("j7_stage_loads", stage_all)
    # The same fact load with the fact registered over its layout (no copy).
    wh_ip = Warehouse(spark, "bench_wh_in_place", location=f"{root}/warehouse_ip",
                      fact_layout=P.fact_path(out))
    timed("j7_fact_register_in_place", lambda: (wh_ip.create_tables([C.FACT_ARRIVALS]),
                                                wh_ip.stage("fact_immigration", out, P.FACT_KEY)))
    timed("j5_state_temperature_dim", lambda: wh.load(
        "state_temperature", J.state_temperature_dim(wh.read("staging_state_temperature"), years),
        "overwrite"))
    timed("j6_date_dim", lambda: wh.load("date_time", J.date_dim(wh.read("fact_immigration")),
                                         "overwrite"))
    timed("q_quality_checks", lambda: Q.assert_passed(P.quality_report(wh), log=lambda *_: None))

    # The analyses need the state code of the demographics, a layout column.
    city = spark.read.parquet(f"{out}/{P.CITY_KEY}")
    fact = wh.read("fact_immigration")
    timed("d1_travel_by_state_month", lambda: noop(A.travel_by_state_month(fact)))
    timed("d2_corr_travel_demographics", lambda: noop(A.corr_travel_demographics(fact, city)))
    timed("d3_corr_travel_temperature", lambda: noop(A.corr_travel_temperature(
        fact, A.state_bridge(city), wh.read("state_temperature"))))

    # The daily run: the latest delivery month arrives again and is merged
    # into the stored fact (month- and id-pruned anti join; nothing is new).
    from pyspark.sql import functions as F
    last = (spark.read.parquet(f"{inp.arrivals}/batch=1")
            .agg(F.max("delivery").alias("m")).first()["m"])
    timed("daily_redelivery_merge", lambda: DY.ingest_deliveries(
        spark, f"{inp.arrivals}/batch=1/delivery={last}", f"{out}/{P.FACT_KEY}",
        f"{root}/daily-sources"))

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "pipeline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

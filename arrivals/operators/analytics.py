"""The three questions the star schema is built to answer.

All are aggregate-then-join plans: each side is reduced to one row per
state (or state and month) with a partial aggregate before any shuffle, so
the joins run on a few hundred rows whatever the fact's size.  Both sides
are hash-partitioned on the join key by their own aggregation, so the join
adds no exchange; AQE may still turn it into a broadcast join once the
real (measured) sizes are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def travel_by_state_month(fact: DataFrame) -> DataFrame:
    """Arrivals per (state, year, month), busiest first."""
    return (fact.groupBy("arr_state",
                         F.year("arrival_date").alias("year"),
                         F.month("arrival_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("arrivals"))
            .orderBy(F.desc("arrivals"), "arr_state", "year", "month"))


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation; null (not an error) when a series is constant.

    ``corr`` divides by zero under ANSI mode for a constant series; the
    population covariance over the product of population deviations is the
    same coefficient with an explicit null for that case.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    den = F.stddev_pop(a) * F.stddev_pop(b)
    return F.covar_pop(a, b) / F.nullif(den, F.lit(0.0))


def state_bridge(demographics: DataFrame) -> DataFrame:
    """Two-letter state code -> state name, from the demographics rows."""
    return demographics.select("state_code", "state").distinct()


def corr_travel_demographics(fact: DataFrame, demographics: DataFrame) -> DataFrame:
    """Correlation of arrivals per state with the state's population.

    Demographics repeat a city's population on every race row, so each
    (city, state, population) counts once before summing per state.
    """
    return corr_arrivals_demographics(fact.groupBy("arr_state").agg(F.count(F.lit(1)).alias("n")), demographics)


def corr_arrivals_demographics(arrivals: DataFrame, demographics: DataFrame) -> DataFrame:
    """The same from arrivals (arr_state, n) that are counted already."""
    pop = (demographics.select("city", "state_code", "tot_pop").distinct()
           .groupBy("state_code").agg(F.sum("tot_pop").alias("pop")))
    j = arrivals.join(pop, arrivals.arr_state == pop.state_code)
    return j.agg(F.round(safe_corr(F.col("n").cast("double"), F.col("pop").cast("double")), 6)
                 .alias("r"))


def corr_travel_temperature(fact: DataFrame, bridge: DataFrame,
                            state_temperature: DataFrame) -> DataFrame:
    """Correlation of arrivals per (state, month) with that month's mean temperature."""
    arrivals = (fact.groupBy("arr_state", F.month("arrival_date").alias("month"))
                .agg(F.count(F.lit(1)).alias("n")))
    return corr_arrivals_temperature(arrivals, bridge, state_temperature)


def corr_arrivals_temperature(arrivals: DataFrame, bridge: DataFrame, state_temperature: DataFrame) -> DataFrame:
    """The same from arrivals (arr_state, month, n) that are counted already."""
    a = arrivals.join(bridge, arrivals.arr_state == bridge.state_code)
    j = a.join(state_temperature, ["state", "month"])
    return j.agg(F.round(safe_corr(F.col("n").cast("double"),
                                   F.col("avg_temperature").cast("double")), 6).alias("r"))


def corr_counts_demographics(counts: DataFrame, demographics: DataFrame) -> DataFrame:
    """:func:`corr_travel_demographics` from kept counts per state, year and month."""
    return corr_arrivals_demographics(counts.groupBy("arr_state").agg(F.sum("arrivals").alias("n")), demographics)


def corr_counts_temperature(counts: DataFrame, bridge: DataFrame, state_temperature: DataFrame) -> DataFrame:
    """:func:`corr_travel_temperature` from kept counts per state, year and month."""
    return corr_arrivals_temperature(counts.groupBy("arr_state", "month").agg(F.sum("arrivals").alias("n")),
                                     bridge, state_temperature)

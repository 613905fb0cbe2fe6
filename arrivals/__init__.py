"""Arrivals star schema on Spark.

A batch library that scans raw arrival, city-demographic, state-temperature
and country-code files, types them against table contracts, derives the
date and temperature dimensions, writes partitioned Parquet, loads tables,
checks data quality and answers three travel questions -- all as DataFrame
and SQL plans that Catalyst optimises.
"""

from arrivals.session import build_session, scratch_dir, shared_root

__all__ = ["build_session", "scratch_dir", "shared_root"]

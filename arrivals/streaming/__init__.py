"""The daily arrivals run as an incremental file stream."""

from arrivals.streaming.daily import ingest_deliveries

__all__ = ["ingest_deliveries"]

"""Incremental ingestion of landed responses with Structured Streaming.

The pipeline is a weekly batch with no catch-up; its only incremental
part is picking up newly landed API responses. A file-source stream with
an ``availableNow`` trigger does exactly that: each run processes the
files that arrived since the previous run and stops, and its checkpoint
(in the shared checkpoint folder) makes the sink exactly-once even when
executors or the driver are lost mid-run.
"""

from destrank.streaming.landing import ingest_forecasts
from destrank.streaming.newest import NewestForecasts, keep_newest_forecasts

__all__ = ["NewestForecasts", "ingest_forecasts", "keep_newest_forecasts"]

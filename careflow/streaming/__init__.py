"""Incremental work on the raw landing folder with Structured Streaming.

The batch warehouse has no streaming semantics to rebuild (no event-time windows, no
watermarks). What is incremental is *adopting new raw files*: ``landing`` types each CSV dropped into
the landing folder once into the staging table, from which the marts can be rebuilt;
``refresh`` keeps the marts up to date itself, replacing only the dates that a batch touches.
"""

from careflow.streaming.landing import ingest_landing, rebuild_from_staging
from careflow.streaming.refresh import refresh_landing, refreshed_warehouse

__all__ = ["ingest_landing", "rebuild_from_staging", "refresh_landing", "refreshed_warehouse"]

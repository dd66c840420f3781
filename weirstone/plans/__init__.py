"""Feeds, and loads of them into stages and targets."""

from .buckets import BucketedTable, buckets_for
from .feeds import (
    BUSINESS_LOCKS,
    CALL_TYPE,
    FEEDS,
    ROUTE_CALL_DETAIL,
    Feed,
    feed,
    flatten,
    parse_feed,
    preview_locks,
)
from .load import (
    OffsetStore,
    database_call,
    ingest,
    load_in_batches,
    losses,
    run_load,
    staged_positions,
    staged_spans,
)
from .presence import PresenceStore
from .targets import Insert, Refresh, Upsert

__all__ = [
    "BUSINESS_LOCKS",
    "CALL_TYPE",
    "BucketedTable",
    "FEEDS",
    "ROUTE_CALL_DETAIL",
    "Feed",
    "Insert",
    "OffsetStore",
    "PresenceStore",
    "Refresh",
    "Upsert",
    "buckets_for",
    "database_call",
    "feed",
    "flatten",
    "ingest",
    "load_in_batches",
    "losses",
    "parse_feed",
    "preview_locks",
    "run_load",
    "staged_positions",
    "staged_spans",
]

"""Snapshot plus change log, replayed into tables with Spark."""

from .operators.apply import current_state, latest_per_key
from .plans.replay import Options, Result, read_changes, read_operations, read_snapshot, replay
from .plans.state import StateStore
from .sources.catalog import catalog

__all__ = [
    "Options",
    "Result",
    "StateStore",
    "catalog",
    "current_state",
    "latest_per_key",
    "read_changes",
    "read_operations",
    "read_snapshot",
    "replay",
]

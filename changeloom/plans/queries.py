"""All registered queries with their SQL."""

from __future__ import annotations

from . import queries_apply, queries_streaming, queries_values, queries_workspace

_MODULES = (queries_apply, queries_values, queries_workspace, queries_streaming)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: text for m in _MODULES for name, text in m.ORACLES.items()}

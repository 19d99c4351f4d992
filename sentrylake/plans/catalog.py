"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from sentrylake.plans import detect, ingest, investigate, measure

_PARTS = (detect, investigate, ingest, measure)
QUERIES = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

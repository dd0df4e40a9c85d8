"""All queries and their SQL, by key."""

from __future__ import annotations

from rivulet.plans import bursts, graph, numeric, scans, streams, text, tweets

_AREAS = (graph, text, bursts, streams, tweets, numeric, scans)
QUERIES = {key: query for area in _AREAS for key, query in area.QUERIES.items()}
ORACLES = {key: sql for area in _AREAS for key, sql in area.ORACLES.items()}

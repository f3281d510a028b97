"""All queries of the engine, by inventory id, with their DuckDB equivalents."""

from __future__ import annotations

from linefold.plans import books, groups, joins, packages, reference, rows, streams, surface, windows  # noqa: F401
from linefold.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401

FLAGSHIP = "win7_segments"

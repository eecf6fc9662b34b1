"""Registered queries of this subpackage and their SQL twins."""
from __future__ import annotations

from barlab.llm import queries as _queries

QUERIES = _queries.QUERIES
ORACLES = _queries.ORACLES

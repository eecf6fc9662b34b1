"""Imports every module that registers queries."""
from barlab.plans import q_calendar, q_indicators, q_membership, q_quality, q_releases, q_research, q_sources, q_summary, q_universe  # noqa: F401
from barlab.plans.registry import ORACLES, QUERIES  # noqa: F401

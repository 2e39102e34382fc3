"""Compositions of sources and operators, and the registered queries."""

from cinelink.plans import load_queries, match_queries, profile_queries, source_queries, text_queries  # noqa: F401
from cinelink.plans.registry import ORACLES, QUERIES  # noqa: F401

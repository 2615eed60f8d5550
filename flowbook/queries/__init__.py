"""The registered queries: operators and reports over the test tables, each with its SQL counterpart."""

from . import (  # noqa: F401  (each module registers its queries)
    calendar_queries,
    codes_and_rules,
    cube_queries,
    dedupe_and_positions,
    files_and_backfill,
    flow_queries,
    joins_and_stacking,
    reports_and_systems,
    storage_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

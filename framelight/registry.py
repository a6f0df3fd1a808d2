"""Every query of the engine by name, with its SQL twin."""

from __future__ import annotations

from framelight.plans import detail_queries  # noqa: F401  registers its queries
from framelight.plans.queries import ORACLE_SQL, QUERIES

FLAGSHIP = "timeline_complete"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]

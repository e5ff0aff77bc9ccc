"""Name -> query and name -> oracle SQL of the engine's own operators."""

from __future__ import annotations

from tetraframe.plans import image_queries, report_queries, source_queries, spot_queries, store_queries, surface_queries, volume_queries
from tetraframe.plans.spot_queries import flagship

_ALL = (spot_queries, surface_queries, image_queries, volume_queries, report_queries, source_queries, store_queries)
QUERIES = {k: q for m in _ALL for k, q in m.BOOK.queries.items()}
ORACLES = {k: q for m in _ALL for k, q in m.BOOK.oracles.items()}

__all__ = ["ORACLES", "QUERIES", "flagship"]

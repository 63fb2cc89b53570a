"""All registered queries: importing this module loads every query module into the catalogue."""

from __future__ import annotations

from marketlake.plans import catalog, q_features, q_model, q_sources, q_streaming, q_tier_a, q_tier_b  # noqa: F401

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE

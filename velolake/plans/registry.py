"""All named queries (batch and streaming) and their oracles."""

from __future__ import annotations

from velolake.plans.catalog import REGISTRY
from velolake.plans.oracle import ORACLE


def all_queries() -> dict:
    from velolake.plans import stream_catalog  # registers streaming queries
    out = dict(REGISTRY)
    out.update(stream_catalog.REGISTRY)
    return out


def all_oracles() -> dict:
    from velolake.plans import stream_catalog
    out = dict(ORACLE)
    out.update(stream_catalog.ORACLE)
    return {k: v for k, v in out.items() if k in all_queries()}

"""Import every plan module so that its queries register themselves."""

from __future__ import annotations

from prodlake.plans import changes, endpoints, ingest, layers  # noqa: F401
from prodlake.plans.registry import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)

"""Collects the registered queries from every plan module."""

from __future__ import annotations

from storefront.plans import catalog


def _load() -> None:
    # importing a plan module registers its queries in catalog.QUERIES/ORACLE
    from storefront.plans import (ingest_plans, io_plans, model_plans, quality_plans,  # noqa: F401
                                  recommend_plans)


def queries():
    _load()
    return dict(catalog.QUERIES)


def oracle_sql():
    _load()
    return dict(catalog.ORACLE)

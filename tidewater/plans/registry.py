"""All registered queries of the library, without the training-data package."""

from __future__ import annotations

from . import assets, enrich, lists, metrics, pages, payloads, queue, records, scalars

MODULES = (scalars, lists, assets, enrich, queue, metrics, records, payloads, pages)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in MODULES for name, s in m.SQL.items()}

"""All registered queries of the core library and their SQL equivalents."""

from __future__ import annotations

from tessera.plans import base, documents, json_text, labels, lookups, matching, records, relational, resolution, unify

MODULES = (relational, json_text, matching, documents, labels, lookups, records, resolution, unify)


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)

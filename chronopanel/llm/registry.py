"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import exact_dedup, fingerprints, language, licenses, mixing, packing, quality, scoring, simhash, substrings

MODULES = [simhash, substrings, packing, exact_dedup, fingerprints, quality, mixing, licenses, language, scoring]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}

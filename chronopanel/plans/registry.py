"""Every registered query and its SQL."""

from __future__ import annotations

from . import q_indicators, q_market, q_more, q_rest, q_series

MODULES = [q_indicators, q_market, q_series, q_more, q_rest]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}

"""DuckDB SQL of every named query that SQL can express."""

from __future__ import annotations

from factloom.plans import queries as _catalogue  # noqa: F401
from factloom.plans.registry import ORACLES


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

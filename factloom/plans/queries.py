"""Every named query; importing the catalogue modules registers them."""

from __future__ import annotations

from factloom.plans import adapters, entities, extras, joins, merges, reduction, reports, rules, scalars_catalogue, streams  # noqa: F401
from factloom.plans.registry import QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)

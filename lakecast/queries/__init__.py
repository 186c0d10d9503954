"""Every registered query with its SQL twin, over the driver's tables."""

from __future__ import annotations

from lakecast.queries import features, fitted, forecasts, increments, loads, lookups, models, quality, surfaces, tables
from lakecast.queries.common import Query

_MODULES = (features, lookups, tables, quality, loads, increments, forecasts, models, fitted, surfaces)


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in _MODULES:
        for query in module.QUERIES:
            if query.name in found:
                raise ValueError(f"query {query.name} is registered twice")
            found[query.name] = query
    return found

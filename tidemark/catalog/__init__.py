"""Named queries over the driver's tables, each with SQL for the same result where there is one."""

from __future__ import annotations

from tidemark.catalog import evaluation, grids, kept, modelling, ranking, ratings, tables, weblog
from tidemark.catalog.registry import Query

ALL: dict[str, Query] = {
    query.name: query
    for module in (weblog, tables, ranking, ratings, evaluation, modelling, grids, kept)
    for query in module.QUERIES
}

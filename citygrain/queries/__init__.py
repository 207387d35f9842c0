"""Registered queries with their SQL counterparts."""

from citygrain.queries.registry import QUERIES, SQL  # noqa: F401
from citygrain.queries import (  # noqa: F401
    geometry_queries,
    network_queries,
    raster_queries,
    source_queries,
    statistics_queries,
)

"""All registered queries; importing this package registers them."""

from tallgrass.catalog import (  # noqa: F401
    count_queries,
    graph_queries,
    model_queries,
    order_queries,
    reading_queries,
    source_queries,
    vector_queries,
)
from tallgrass.catalog.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]

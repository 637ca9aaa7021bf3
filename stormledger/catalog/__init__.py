"""Driver queries. Importing the package registers all of them."""

from stormledger.catalog import (  # noqa: F401
    aggregates,
    expressions,
    files,
    joins,
    pipelines,
    ranking,
    streams,
)
from stormledger.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

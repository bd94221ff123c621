"""All registered queries."""

from countertide.catalog import (  # noqa: F401
    evaluation,
    feature_tables,
    histories,
    ingestion,
    integrity,
    mining,
    models,
    scalars,
    selections,
    statistics,
    streams,
)
from countertide.catalog.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query"]

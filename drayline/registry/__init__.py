"""Named queries over the test tables, each with an independent SQL formulation."""

from drayline.registry import (  # noqa: F401  (importing registers the queries)
    bi,
    drift,
    feeds,
    fleet,
    maintenance,
    monitoring,
    quality,
    reshaping,
    runs,
    scalars,
    streams,
)
from drayline.registry.base import QUERIES

__all__ = ["QUERIES"]

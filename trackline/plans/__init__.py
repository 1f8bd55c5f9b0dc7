"""Views over the given tables and the registered queries."""

from trackline.plans import (  # noqa: F401  (each registers its queries)
    feed,
    files,
    labelling,
    places,
    reports,
    resample,
    routes,
    stores,
    tracks,
)
from trackline.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

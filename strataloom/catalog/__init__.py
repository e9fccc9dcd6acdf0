"""Registered queries with the SQL that states the same result."""

from strataloom.catalog import (  # noqa: F401  (each module registers its queries)
    aggregation,
    incremental,
    joining,
    modelling,
    privacy,
    projection,
    quality,
    scalars,
    serving,
    sourcing,
    streaming,
    windowing,
)
from strataloom.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

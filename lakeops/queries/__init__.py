"""Importing this package registers every checked query."""
from lakeops.queries import (  # noqa: F401
    aggregates,
    endtoend,
    joined,
    projections,
    state,
    stored,
    windowed,
)

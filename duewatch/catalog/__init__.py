"""Every operator as a named query over the given tables."""

from duewatch.catalog import (  # noqa: F401  (importing a module registers its queries)
    cleaning_queries,
    feature_queries,
    label_queries,
    model_queries,
    monitor_queries,
    table_queries,
)
from duewatch.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

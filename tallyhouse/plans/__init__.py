"""Named queries over a data folder, and their SQL counterparts."""

from . import analytics, loading, oracle_analytics, oracle_loading, oracle_quality, quality
from .registry import REGISTRY, runnable

SQL = {**oracle_analytics.SQL, **oracle_loading.SQL, **oracle_quality.SQL}

__all__ = ["REGISTRY", "SQL", "analytics", "loading", "quality", "runnable"]

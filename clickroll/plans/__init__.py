"""Job chains, and the registered queries with their SQL twins."""

from clickroll.plans import (  # noqa: F401
    article_queries, counter_queries, job_queries, scan_queries, stream_queries,
)
from clickroll.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

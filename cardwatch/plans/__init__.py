"""Named queries over the given tables."""

from cardwatch.plans import (group_queries, io_queries, model_queries, period_queries,  # noqa: F401
                             row_queries, stream_queries, window_queries)
from cardwatch.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

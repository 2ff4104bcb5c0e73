"""Reports of the warehouse over the days they cover, up to any day.

A report is any function of a table; its rows are cut to whole days before anything is aggregated, so files and folders
of other days are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions import numbers
from cardwatch.operators import aggregates, dashboards

Report = Callable[..., DataFrame]


def feature_correlations(scored: DataFrame) -> DataFrame:
    """Amount, foreign use and balance against detected frauds."""
    return dashboards.correlations(scored, {
        "amount": F.col(numbers.CENTS), "is_international": F.col("is_international"),
        "previous_balance": numbers.cents("previous_balance")})


# Days before the day of the report that each one covers.
REPORTS: dict[str, tuple[Report, int]] = {
    "hourly_velocity": (aggregates.hourly_velocity, 0),
    "fraud_merchants": (partial(dashboards.top_fraud_merchants, label=dashboards.HIT, min_rows=100, min_frauds=0, n=50), 30),
    "hours_of_day": (aggregates.predicted_by_hour, 30),
    "cube": (aggregates.cube_by_risk, 7),
    "segments": (aggregates.segments, 7),
    "correlations": (feature_correlations, 30),
    "score_deciles": (dashboards.score_deciles, 7),
    "confusion": (dashboards.confusion_by_day, 7),
    "precision_recall": (dashboards.precision_recall, 7),
}


def report(name: str, scored: DataFrame, as_of: Column | None = None, days: int | None = None, **options) -> DataFrame:
    """The named report over the day of ``as_of`` (left out, the latest in the table) and ``days`` days before it.

    Rows without a time belong to no day. Options go to the report.
    """
    make, usual = REPORTS[name]
    return make(dashboards.last_days(scored, usual if days is None else days, as_of), **options)

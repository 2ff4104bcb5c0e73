"""Reports of the warehouse as of a day before the latest, so both ends of their periods leave rows out."""

from pyspark.sql import functions as F

from cardwatch.functions import rules
from cardwatch.operators import dashboards, periods, shape
from cardwatch.plans import group_queries  # noqa: F401  (the undated queries, whose SQL is restated over the period)
from cardwatch.plans.catalog import ORACLES, query, scored, tx_balance
from cardwatch.plans.sql import DATE, LAST_DAY, PRELUDE

#: Days between the day of the reports and the latest day.
EARLIER = 3

#: Report, the query whose SQL holds for all days, its table there, and other days than the usual ones.
DATED = {
    "hourly_velocity": ("hourly_velocity", "tx", None),
    "fraud_merchants": ("top_fraud_merchants_large", "scored", 20),
    "hours_of_day": ("hourly_predicted", "scored", 20),
    "cube": ("cube_grouping_order", "scored", None),
    "segments": ("segment_analysis", "scored", None),
    "correlations": ("feature_corr", "scored", 20),
    "score_deciles": ("score_deciles", "scored", None),
    "confusion": ("confusion_daily", "scored", None),
    "precision_recall": ("pr_curve", "scored", None),
}


def _sql(base: str, table: str, days: int) -> str:
    day = f"({LAST_DAY} - {EARLIER})"
    inside = f", recent AS (SELECT * FROM {table} WHERE {DATE} BETWEEN {day} - {days} AND {day}) "
    return inside + ORACLES[base][len(PRELUDE):].replace(f"FROM {table}", "FROM recent")


def _register(name: str, base: str, table: str, days: int | None) -> None:
    usual = periods.REPORTS[name][1]

    @query(f"period_{name}", _sql(base, table, usual if days is None else days))
    def _(spark, sf):
        rows = scored(spark, sf)
        if name == "correlations":
            rows = rules.apply(shape.enrich(tx_balance(spark, sf)), rules.stream_rules())
        as_of = F.date_sub(F.to_date(F.timestamp_millis(dashboards.latest_ms(rows))), EARLIER)
        return periods.report(name, rows, as_of, days)


for _name, (_base, _table, _days) in DATED.items():
    _register(_name, _base, _table, _days)

"""The driver's star-schema tables seen as card transactions.

One transaction per event; the balance before the transaction comes from the
customer's account. Constants below are the agreed mapping, not tuning knobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.rules import CATEGORIES
from cardwatch.session import tune

# Fixed values of the mapping, each list indexed from 0.
CURRENCIES = ("EUR", "USD", "GBP", "CHF")
CITIES = ("Paris", "London", "New York", "Tokyo", "Singapore", "Dubai")
COUNTRIES = ("FR", "GB", "US", "JP", "SG", "AE")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({index} AS INT) + 1)"


_MERCHANT = "event_id * 31 % 97"
_COLUMNS = {
    "transaction_id": "concat('TX', timestamp_ms, '-', event_id)",
    "customer_id": "concat('CUST', user_id)",
    "merchant_id": f"concat('MERCH', {_MERCHANT})",
    "amount": "amount_cents / 100",
    "currency": _pick(CURRENCIES, "event_id % 4"),
    "transaction_type": "CASE event_type WHEN 'view' THEN 'WITHDRAWAL' WHEN 'signup' THEN 'TRANSFER' ELSE 'PURCHASE' END",
    "channel": "CASE event_type WHEN 'purchase' THEN 'ONLINE' WHEN 'click' THEN 'POS' WHEN 'view' THEN 'ATM' "
               "ELSE 'MOBILE' END",
    "location": _pick(CITIES, "event_id * 7 % 6"),
    "device_id": "CASE WHEN event_id % 7 <> 0 THEN concat('DEV', event_id * 11 % 200) END",
    "ip_address": "CASE WHEN event_type <> 'view' THEN concat('10.0.', event_id * 3 % 256, '.', event_id % 256) END",
    "timestamp_ms": "timestamp_ms",
    "card_type": "IF(event_id % 3 = 0, 'DEBIT', 'CREDIT')",
    "is_international": "event_id * 17 % 10 = 3",
    "merchant_category": _pick(CATEGORIES, f"{_MERCHANT} % 11"),
    "is_fraud": "CASE WHEN event_id % 101 <> 0 THEN event_type = 'purchase' AND value > 125 OR event_id % 41 = 0 END",
    "country": _pick(COUNTRIES, "event_id * 7 % 6"),
    "amount_cents": "amount_cents",
    "_user_id": "user_id",
}


def from_events(events: DataFrame) -> DataFrame:
    """Row-local part of the mapping; works on a batch and on a stream."""
    based = events.selectExpr(
        "event_id", "user_id", "event_type", "value",
        "unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000 AS timestamp_ms",
        "CASE event_type WHEN 'purchase' THEN CAST(round(value * 100) AS BIGINT) * 40 "
        "WHEN 'error' THEN CAST(round(value * 100) AS BIGINT) DIV 20 "
        "ELSE CAST(round(value * 100) AS BIGINT) * 10 END AS amount_cents")
    return based.selectExpr(*[f"{text} AS {name}" for name, text in _COLUMNS.items()])


def transactions(spark: SparkSession, sf_dir: str, balance: bool = False) -> DataFrame:
    """The transaction table. ``previous_balance`` needs the join with the customers, so it is on demand."""
    tune(spark)
    rows = from_events(table(spark, sf_dir, "events"))
    if not balance:
        return rows.drop("_user_id")
    accounts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_user_id"), F.greatest("c_acctbal", F.lit(0.0)).alias("previous_balance"))
    return rows.join(accounts, "_user_id", "left").drop("_user_id")

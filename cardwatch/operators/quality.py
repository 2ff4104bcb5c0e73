"""Row validation against the record's rules, and quality figures of a table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.numbers import count_if, ratio
from cardwatch.schemas import TRANSACTION


@dataclass(frozen=True)
class RecordRules:
    required: tuple[str, ...] = ()
    patterns: dict[str, str] = field(default_factory=dict)
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    minimum: dict[str, float] = field(default_factory=dict)


# The published rules of the transaction record.
TRANSACTION_RULES = RecordRules(
    required=tuple(f.name for f in TRANSACTION if not f.nullable),
    patterns={
        "transaction_id": "^TX[0-9]+-[0-9]+$",
        "customer_id": "^CUST[0-9]+$",
        "merchant_id": "^MERCH[0-9]+$",
        "ip_address": r"^((25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$",
    },
    allowed={
        "currency": ("EUR", "USD", "GBP", "CHF", "JPY"),
        "transaction_type": ("PURCHASE", "WITHDRAWAL", "TRANSFER", "REFUND"),
        "channel": ("ONLINE", "POS", "ATM", "MOBILE"),
        "card_type": ("CREDIT", "DEBIT"),
    },
    minimum={"amount": 0, "previous_balance": 0},
)


def violations(rules: RecordRules) -> Column:
    """Array of ``kind:column`` for every broken rule; a null breaks only ``required``."""
    checks = [(F.col(c).isNull(), f"required:{c}") for c in rules.required]
    checks += [(~F.col(c).rlike(p), f"pattern:{c}") for c, p in rules.patterns.items()]
    checks += [(~F.col(c).isin(*v), f"enum:{c}") for c, v in rules.allowed.items()]
    checks += [(F.col(c) < v, f"minimum:{c}") for c, v in rules.minimum.items()]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for broken, name in checks]))


def validate(df: DataFrame, rules: RecordRules = TRANSACTION_RULES) -> DataFrame:
    return df.withColumn("violations", violations(rules))


def violation_counts(df: DataFrame, rules: RecordRules = TRANSACTION_RULES) -> DataFrame:
    return (df.select(F.explode(violations(rules)).alias("violation")).groupBy("violation")
            .agg(F.count("*").alias("row_count")))


def quality(df: DataFrame, required: tuple[str, ...] = TRANSACTION_RULES.required, key: str = "transaction_id",
            max_null_rate: float = 0.05, max_duplicate_rate: float = 0.01, exact: bool = True) -> DataFrame:
    """Rows, share of rows with a missing required value, share of repeated ids, and whether all is within limits.

    ``exact=False`` replaces the distinct count, which shuffles every id, by a fixed-size sketch.
    """
    present = [c for c in required if c in df.columns]
    incomplete = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in present], F.lit(False))
    distinct = F.count_distinct(key) if exact else F.approx_count_distinct(key, 0.01)
    n, nulls = F.count("*"), count_if(incomplete)
    repeated = F.greatest(F.count(key) - distinct, F.lit(0))
    return df.agg(n.alias("total_rows"), ratio(nulls, n).alias("null_rate"),
                  ratio(repeated, n).alias("duplicate_rate"),
                  F.lit(len(present) == len(required)).alias("schema_valid")).withColumn(
        "passed", F.col("schema_valid") & (F.coalesce("null_rate", F.lit(0.0)) <= max_null_rate)
        & (F.coalesce("duplicate_rate", F.lit(0.0)) <= max_duplicate_rate))


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_level").agg(F.count("*").alias("alert_count"))

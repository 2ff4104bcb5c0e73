"""Normalising, projections, filters and derived columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions import numbers, rules, times
from cardwatch.schemas import FIELD_NAMES, TRANSACTION, VARIANT_NAMES

# Upper bounds (exclusive) and labels of the amount bands.
BANDS = ((100, "LOW"), (1000, "MEDIUM"), (5000, "HIGH"))
BANDS_NOTEBOOK = ((100, "LOW"), (500, "MEDIUM"), (2000, "HIGH"))
BANDS_CLOUD = ((50, "MICRO"), (200, "LOW"), (1000, "MEDIUM"), (5000, "HIGH"))
TOP_BAND = "VERY_HIGH"


def normalize(df: DataFrame) -> DataFrame:
    """Any variant of the record to canonical names and types.

    Absent columns become nulls, ``amount_cents`` is added. Types may differ where a column was a
    partition folder, whose values are read back as text.
    """
    known = {**FIELD_NAMES, **VARIANT_NAMES}
    renamed = df.withColumnsRenamed({a: b for a, b in known.items() if a in df.columns})
    types = {f.name: f.dataType for f in renamed.schema}
    changed = {f.name: (F.col(f.name) if f.name in types else F.lit(None)).cast(f.dataType)
               for f in TRANSACTION if types.get(f.name) != f.dataType}
    return renamed.withColumns(changed).withColumn(numbers.CENTS, numbers.cents("amount"))


def basic_info(df: DataFrame) -> DataFrame:
    return df.select("transaction_id", "customer_id", "amount", "timestamp_ms", "is_fraud")


def amounts(df: DataFrame) -> DataFrame:
    return df.select("amount")


def customer_locations(df: DataFrame, unique: bool = False) -> DataFrame:
    pairs = df.select("customer_id", "location")
    return pairs.distinct() if unique else pairs


def high_value(df: DataFrame, threshold: float = 1000) -> DataFrame:
    return df.where(F.col("amount") > threshold)


def high_risk(df: DataFrame) -> DataFrame:
    return df.where((F.col("amount") > 5000) | rules.foreign_over(1000)()
                    | rules.category_in(rules.RISKY_WITH_WIRE)())


def band(amount: Column, bands: Sequence[tuple[float, str]] = BANDS) -> Column:
    chain = F
    for limit, label in bands:
        chain = chain.when(amount < limit, label)
    return chain.otherwise(TOP_BAND)


def derive(df: DataFrame) -> DataFrame:
    """Hour, weekday, high-amount flag, first-match risk score and amount band."""
    score = rules.RuleSet("derived", ((rules.Rule(80, rules.over(10000)), rules.Rule(50, rules.over(5000)),
                                       rules.Rule(40, rules.foreign_over(1000))),)).points()
    return df.withColumns({
        "hour": times.hour_of_day(),
        "day_of_week": times.day_of_week(),
        "is_high_amount": F.col("amount") > 5000,
        "risk_score": F.when(score == 0, 10).otherwise(score) / F.lit(100),
        "amount_category": band(F.col("amount")),
    })


def derive_additive(df: DataFrame) -> DataFrame:
    """Variant with additive score and the lower bands."""
    score = rules.RuleSet("additive", ((rules.Rule(40, rules.over(5000)),),
                                       (rules.Rule(30, rules.category_in(rules.RISKY)),),
                                       (rules.Rule(20, rules.foreign_over(1000)),))).points()
    return df.withColumns({
        "hour": times.hour_of_day(),
        "is_high_amount": F.col("amount") > 1000,
        "amount_category": band(F.col("amount"), BANDS_NOTEBOOK),
        "risk_score": score / F.lit(100),
    })


def enrich(df: DataFrame, bands: Sequence[tuple[float, str]] = BANDS,
           risky: tuple[str, ...] = rules.RISKY_WITH_WIRE, time: Column | None = None,
           night: tuple[int, int] = (0, 5)) -> DataFrame:
    """Time, band and merchant flags used by the rule sets.

    ``time`` is the event time by default; a stream may pass its arrival time.
    """
    hour = times.hour_of_day() if time is None else F.hour(time)
    weekday = times.day_of_week() if time is None else F.dayofweek(time)
    return df.withColumns({
        "hour": hour,
        "day_of_week": weekday,
        "is_weekend": weekday.isin(1, 7),
        "is_suspicious_hour": times.is_night(hour, *night),
        "amount_category": band(F.col("amount"), bands),
        "is_risky_merchant": F.col("merchant_category").isin(*risky),
    })


def enrich_notebook(df: DataFrame) -> DataFrame:
    return enrich(df, BANDS_NOTEBOOK, rules.RISKY)


def enrich_balance(df: DataFrame) -> DataFrame:
    """Cloud variant: finer bands, amount-to-balance ratio, processing time."""
    return enrich(df, BANDS_CLOUD, rules.RISKY).withColumns({
        "processed_at": F.current_timestamp(),
        "transaction_time": times.event_time(),
        "is_high_amount": F.col("amount") > 5000,
        "amount_to_balance_ratio": F.when(F.col("previous_balance") > 0, F.col("amount") / F.col("previous_balance"))
        .otherwise(F.lit(1.0)),
    })


def with_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({"transaction_date": times.event_date(), "processing_date": F.current_date()})


def largest(df: DataFrame, threshold: float = 1000, n: int = 100) -> DataFrame:
    """The n largest transactions over the threshold."""
    return (df.where(F.col("amount") > threshold)
            .select("transaction_id", "customer_id", "amount", "merchant_category", "is_international", "is_fraud")
            .orderBy(F.desc("amount"), "transaction_id").limit(n))


def alerts_only(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("alert_required"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the keys of the left side are kept."""
    named = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_same_{k}"]) for k in keys])
    return left.join(named, on, how).drop(*[f"_same_{k}" for k in keys])


def fill_missing(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    return df.na.fill(0.0, list(numeric)).na.fill("UNKNOWN", list(categorical))


def flags_to_numbers(df: DataFrame, **types: str) -> DataFrame:
    """``flags_to_numbers(df, is_fraud="double")`` adds ``is_fraud_num``."""
    return df.withColumns({f"{name}_num": F.col(name).cast(kind) for name, kind in types.items()})


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """One frame out of several batches, matched by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first

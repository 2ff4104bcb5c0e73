"""Customer profiles, merchant risk, hourly metrics, alerts, predictions, and the jobs that join them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions import numbers, rules, times
from cardwatch.functions.numbers import count_if, mean, ratio, total, total_if
from cardwatch.operators import windows
from cardwatch.operators.aggregates import hourly_velocity, labelled, mean_score, rows
from cardwatch.operators.busy import ROWS
from cardwatch.operators.dashboards import HIT, last_days
from cardwatch.operators.spread import join_per_key
from cardwatch.schemas import WAREHOUSE

# Fixed values of our merchant score: prior frauds per prior rows, and the lowest score of each category.
PRIOR_FRAUDS, PRIOR_ROWS = 0.4, 20
MERCHANT_LEVELS = (("HIGH", 0.10), ("MEDIUM", 0.05))


def to_warehouse(df: DataFrame, table: str) -> DataFrame:
    """The columns of a warehouse table in its order and types; absent ones become nulls."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in WAREHOUSE[table]])


def preferred(df: DataFrame, value: str, name: str, k: int = 3) -> DataFrame:
    """The k most frequent values per customer, most frequent first.

    Counts come first; the row_number filter lets Spark keep only k candidates
    per customer before the shuffle.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy("customer_id", value).agg(rows().alias("_n"))
    order = Window.partitionBy("customer_id").orderBy(F.desc("_n"), value)
    best = counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    ranked = F.sort_array(F.collect_list(F.struct("_r", value)))
    return best.groupBy("customer_id").agg(F.transform(ranked, lambda e: e[value]).alias(name))


def customer_profiles(df: DataFrame, k: int = 3) -> DataFrame:
    days = F.datediff(F.max(times.event_date()), F.min(times.event_date())) + 1
    base = df.groupBy("customer_id").agg(
        mean().alias("avg_transaction_amount"), numbers.stdev().alias("std_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"), rows().alias("total_transactions"),
        (rows() / days).alias("avg_transactions_per_day"), labelled().alias("fraud_count"),
        ratio(labelled(), rows()).alias("fraud_rate"),
        F.timestamp_millis(F.max("timestamp_ms")).alias("last_transaction_time"))
    return (base.join(preferred(df, "location", "preferred_locations", k), "customer_id", "left")
            .join(preferred(df, "merchant_id", "preferred_merchants", k), "customer_id", "left"))


def profile_basics(df: DataFrame) -> DataFrame:
    """The part of the profile that scoring needs, in one aggregation."""
    return df.groupBy("customer_id").agg(
        mean().alias("profile_avg_amount"), F.max("amount").alias("profile_max_amount"),
        labelled().alias("history_fraud_count"))


def merchant_risk(df: DataFrame) -> DataFrame:
    """Merchant totals with a fraud rate smoothed towards the usual rate, so small merchants are not extreme."""
    hit = F.col("is_fraud")
    out = df.groupBy("merchant_id", "merchant_category").agg(
        rows().alias("total_transactions"), total().alias("total_volume"), count_if(hit).alias("fraud_count"),
        total_if(hit).alias("fraud_volume"), ratio(count_if(hit), rows()).alias("fraud_rate"),
        ((count_if(hit) + F.lit(PRIOR_FRAUDS)) / (rows() + F.lit(PRIOR_ROWS))).alias("risk_score"))
    category = F
    for name, lowest in MERCHANT_LEVELS:
        category = category.when(F.col("risk_score") >= lowest, name)
    return out.withColumn("risk_category", category.otherwise("LOW"))


def hourly_metrics(scored: DataFrame, processed_at: str | None = None) -> DataFrame:
    """One row per hour; latency is processing time minus event time where the input knows the former."""
    hit, lvl = F.col(HIT), F.col("risk_level")
    latency = (F.avg(F.unix_millis(F.col(processed_at)) - F.col("timestamp_ms")) if processed_at
               else F.lit(None).cast("double"))
    return scored.groupBy(F.date_trunc("hour", times.event_time()).alias("metric_hour")).agg(
        rows().alias("total_transactions"), total().alias("total_volume"), mean().alias("avg_amount"),
        count_if(hit).alias("fraud_count"), total_if(hit).alias("fraud_volume"),
        ratio(count_if(hit), rows()).alias("fraud_rate"), count_if(lvl == "CRITICAL").alias("critical_alerts"),
        count_if(lvl == "HIGH").alias("high_alerts"), latency.alias("avg_latency_ms"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_id").alias("unique_merchants"))


def alert_reasons(max_amount: float = 5000) -> Column:
    """The four reason codes; empty array if none applies."""
    return rules.reasons([
        (rules.over(max_amount), F.lit("HIGH_AMOUNT")),
        (rules.foreign_over(1000), F.lit("HIGH_INTERNATIONAL_TX")),
        (rules.flagged("is_suspicious_hour"), F.lit("SUSPICIOUS_HOUR")),
        (rules.category_in(rules.RISKY_WITH_WIRE), F.lit("RISKY_MERCHANT")),
    ])


def suspicious(df: DataFrame) -> DataFrame:
    """Rows with at least one of the four batch reasons, with the reasons as text."""
    hour = times.hour_of_day()
    texts = rules.reasons([
        (rules.over(5000), F.concat(F.lit("HIGH_AMOUNT: "), F.col("amount").cast("string"))),
        (rules.foreign_over(1000), F.lit("HIGH_INTERNATIONAL_TX")),
        (lambda: times.is_night(hour), F.concat(F.lit("SUSPICIOUS_HOUR: "), hour.cast("string"))),
        (rules.category_in(rules.RISKY_WITH_WIRE),
         F.concat(F.lit("RISKY_MERCHANT_CATEGORY: "), F.col("merchant_category"))),
    ])
    return df.withColumn("reasons", texts).where(F.size("reasons") > 0)


def suspicious_short(df: DataFrame) -> DataFrame:
    """Variant with three reasons."""
    texts = rules.reasons([
        (rules.over(5000), F.format_string("HIGH_AMOUNT: %.2f€", "amount")),
        (rules.category_in(rules.RISKY), F.concat(F.lit("RISKY_CATEGORY: "), F.col("merchant_category"))),
        (rules.foreign_over(1000), F.lit("HIGH_INTERNATIONAL")),
    ])
    return df.withColumn("reasons", texts).where(F.size("reasons") > 0)


def alert_events(scored: DataFrame) -> DataFrame:
    """One open alert per transaction and reason. The id is a hash, so a repeated run gives the same alerts."""
    kind = F.explode_outer(alert_reasons()).alias("alert_type")
    alerts = scored.where(F.col("alert_required")).select("*", kind)
    return alerts.withColumns({
        "alert_id": F.sha2(F.concat_ws("|", "transaction_id", "alert_type"), 256),
        "alert_level": F.when(F.col("risk_level") == "CRITICAL", "CRITICAL").otherwise("WARNING"),
        "description": F.concat_ws(" ", F.col("alert_type"), F.lit("for"), F.col("customer_id"), F.lit("amount"),
                                   F.format_string("%.2f", "amount")),
        "status": F.lit("OPEN"),
        "created_at": times.event_time(),
        "alert_date": times.event_date(),
    })


def predictions(scored: DataFrame, model_version: str = "rules-1") -> DataFrame:
    """Rule scores in the shape of the prediction table."""
    return scored.withColumns({
        "prediction_id": F.sha2(F.concat_ws("|", F.col("transaction_id"), F.lit(model_version)), 256),
        "fraud_probability": F.col("fraud_score"),
        "alert_reasons": alert_reasons(),
        "model_version": F.lit(model_version),
        "prediction_date": times.event_date(),
    })


# --- joins -------------------------------------------------------------------------------------------------------

def join_profiles(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join on the customer, spread for customers with very many rows."""
    return join_per_key(df, profiles)


def adjust_score(scored: DataFrame, basics: DataFrame) -> DataFrame:
    """Score raised by what the profile says: above its maximum, far above its mean, or fraud in the past.

    Works on a stream as well, with the static profile on the right.
    """
    joined = join_profiles(scored, basics)
    joined = joined.withColumns({
        "amount_deviation": F.coalesce((F.col("amount") - F.col("profile_avg_amount"))
                                       / F.nullif(F.col("profile_avg_amount"), F.lit(0.0)), F.lit(0.0)),
        "exceeds_historical_max": F.coalesce(F.col("amount") > F.col("profile_max_amount"), F.lit(False)),
        "has_historical_fraud": F.coalesce(F.col("history_fraud_count") > 0, F.lit(False)),
    })
    extra = (F.when(F.col("exceeds_historical_max"), 20).when(F.col("amount_deviation") > 2, 15)
             .when(F.col("has_historical_fraud"), 10).otherwise(0))
    return joined.withColumn("adjusted_fraud_score", (F.col("score_points") + extra) / F.lit(100))


def zscore_population(df: DataFrame) -> DataFrame:
    """z-score against all rows of the customer, population deviation, 0 where it is 0.

    Aggregate and join back: the aggregate is combined before its shuffle, and
    the join spreads a busy customer, which a window over the customer cannot.
    """
    stats = df.groupBy("customer_id").agg(mean().alias("_avg"), numbers.stdev(sample=False).alias("_std"))
    z = F.when(F.col("_std") > 0, (F.col("amount") - F.col("_avg")) / F.col("_std")).otherwise(F.lit(0.0))
    return join_per_key(df, stats, how="inner").withColumn("amount_zscore", z).drop("_avg", "_std")


def abnormal_customers(df: DataFrame, min_rows: int = 3) -> DataFrame:
    """Rows more than two sample deviations from the customer's mean."""
    stats = df.groupBy("customer_id").agg(mean().alias("avg_amount"), numbers.stdev().alias("stddev_amount"),
                                          rows().alias("_n")).where(F.col("_n") >= min_rows)
    z = (F.col("amount") - F.col("avg_amount")) / F.nullif(F.col("stddev_amount"), F.lit(0.0))
    size = F.abs(F.col("z_score"))
    return (join_per_key(df, stats, how="inner").withColumn("z_score", z).where(size > 2)
            .select("transaction_id", "customer_id", "amount", "avg_amount", "stddev_amount", "z_score",
                    F.when(size > 3, "EXTREME_OUTLIER").otherwise("OUTLIER").alias("anomaly_status"))
            .orderBy(F.desc(size), "transaction_id"))


def velocity_vs_profile(df: DataFrame, profiles: DataFrame, max_count: int = 10, max_places: int = 3,
                        n: int | None = 100, as_of: Column | None = None, days: int | None = 0) -> DataFrame:
    """Busy customer hours against the customer's usual number of transactions per day."""
    recent = df if days is None else last_days(df, days, as_of)
    busy = hourly_velocity(recent).where((F.col("tx_count") > max_count) | (F.col("unique_locations") > max_places))
    out = busy.join(profiles.select("customer_id", "avg_transactions_per_day"), "customer_id", "left").withColumn(
        "velocity_ratio", F.col("tx_count") / F.nullif(F.col("avg_transactions_per_day"), F.lit(0.0)))
    ordered = out.orderBy(F.desc("tx_count"), "customer_id", "hour")
    return ordered if n is None else ordered.limit(n)


def card_testing_hours(df: DataFrame, min_rows: int = 3, below: float = 5) -> DataFrame:
    """Small transactions of the hours in which a customer has several of them."""
    small = df.where(F.col("amount") < below).withColumn("hour", F.date_trunc("hour", times.event_time()))
    hours = small.groupBy("customer_id", "hour").agg(
        rows().alias("small_tx_count"), total().alias("total_small_amount")
    ).where(F.col("small_tx_count") >= min_rows)
    known = hours.select("customer_id", "hour", F.col("small_tx_count").alias(ROWS))
    return (join_per_key(small, hours, ["customer_id", "hour"], "inner", sizes=known)
            .select("customer_id", "hour", "small_tx_count", "total_small_amount", "transaction_id",
                    "merchant_category", "channel")
            .orderBy("customer_id", "hour", "transaction_id"))


def first_customers(df: DataFrame, min_rows: int = 3, n: int = 3) -> DataFrame:
    """Running totals of the first n customers that have enough rows (semi join with a limited list)."""
    chosen = (df.groupBy("customer_id").agg(rows().alias("_n")).where(F.col("_n") >= min_rows)
              .orderBy("customer_id").limit(n).select("customer_id"))
    few = df.join(F.broadcast(chosen), "customer_id", "left_semi")
    return windows.running_with_ties(few).select(
        "customer_id", "transaction_id", "amount", F.col("tx_number").alias("tx_num"),
        F.col("cumulative_amount").alias("cumul_amount"), "total_tx")


def high_risk_customers(scored: DataFrame, profiles: DataFrame, min_score: float = 0.5, min_rate: float = 0.01,
                        days: int = 30, n: int = 100, as_of: Column | None = None) -> DataFrame:
    """Customers with a high mean score or a past of fraud; rows are aggregated before the join."""
    recent = last_days(scored, days, as_of).groupBy("customer_id").agg(
        rows().alias("transaction_count"), total().alias("total_amount"), mean_score().alias("avg_fraud_score"),
        count_if(F.col(HIT)).alias("fraud_predictions"))
    past = profiles.select("customer_id", F.col("fraud_count").alias("historical_frauds"),
                           F.col("fraud_rate").alias("historical_fraud_rate"))
    return (recent.join(past, "customer_id", "left")
            .where((F.col("avg_fraud_score") > min_score) | (F.col("historical_fraud_rate") > min_rate))
            .orderBy(F.desc("avg_fraud_score"), "customer_id").limit(n))


def investigation_queue(scored: DataFrame, profiles: DataFrame, days: int = 0, n: int = 100,
                        as_of: Column | None = None) -> DataFrame:
    """Severe rows that are large, far above the customer's mean, or of a customer with past fraud."""
    severe = last_days(scored, days, as_of).where(F.col("alert_required"))
    past = profiles.select("customer_id", F.col("fraud_count").alias("historical_frauds"), "avg_transaction_amount")
    ratio_to_mean = F.col("amount") / F.nullif(F.col("avg_transaction_amount"), F.lit(0.0))
    return (join_per_key(severe, past).withColumn("amount_ratio", ratio_to_mean)
            .where((F.col("amount") > 5000) | (F.col("amount_ratio") > 5) | (F.col("historical_frauds") > 0))
            .select("transaction_id", "customer_id", "amount", "merchant_category", "location", "fraud_score",
                    "risk_level", "historical_frauds", "avg_transaction_amount", "amount_ratio")
            .orderBy(F.desc("fraud_score"), "transaction_id").limit(n))

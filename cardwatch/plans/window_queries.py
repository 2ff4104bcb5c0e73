"""Windows per customer and the joins with profiles."""

from pyspark.sql import functions as F

from cardwatch.operators import aggregates, profiles, windows
from cardwatch.plans.catalog import query, scored, tx
from cardwatch.plans.sql import (C, DATE, HITS, HOUR_START, LAST_DAY, MEAN, N, SCORE, STDEV, STDEV_POP, TOTAL, W_CUSTOMER)

SUM_OVER = f"CAST(SUM({C}) OVER {{}} AS DOUBLE) / 100"
HOUR_FRAME = "(PARTITION BY customer_id ORDER BY timestamp_ms RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW)"
FAST = "COALESCE(location <> p_location AND timestamp_ms - p_ms < 1800000, FALSE)"


@query("rolling_cumulative", f"""SELECT transaction_id, {SUM_OVER.format('w')} AS cumulative_amount,
    ROW_NUMBER() OVER w AS transaction_number FROM tx WINDOW w AS ({W_CUSTOMER} ROWS UNBOUNDED PRECEDING)""")
def _(spark, sf):
    return windows.rolling(tx(spark, sf)).select("transaction_id", "cumulative_amount", "transaction_number")


@query("rolling_last10", f"""SELECT transaction_id, {SUM_OVER.format('w')} / COUNT(*) OVER w AS avg_last10,
    MAX(amount) OVER w AS max_last10, COUNT(*) OVER w AS count_last10
    FROM tx WINDOW w AS ({W_CUSTOMER} ROWS 9 PRECEDING)""")
def _(spark, sf):
    return windows.rolling(tx(spark, sf)).select("transaction_id", "avg_last10", "max_last10", "count_last10")


def _velocity(count, amount):
    return f"""SELECT transaction_id, n AS tx_count_last_hour, s AS amount_last_hour,
        n > {count} OR s > {amount} AS velocity_anomaly FROM (SELECT transaction_id, COUNT(*) OVER {HOUR_FRAME} AS n,
        {SUM_OVER.format(HOUR_FRAME)} AS s FROM tx)"""


VELOCITY = ("transaction_id", "tx_count_last_hour", "amount_last_hour", "velocity_anomaly")


@query("velocity_hour", _velocity(10, 10000))
def _(spark, sf):
    return windows.velocity(tx(spark, sf)).select(*VELOCITY)


@query("velocity_hour_low", _velocity(1, 5000))
def _(spark, sf):
    """Limits low enough to be reached in the given tables."""
    return windows.velocity(tx(spark, sf), max_count=1, max_amount=5000).select(*VELOCITY)


@query("merchant_rankings", """SELECT transaction_id, merchant_category, amount, rank_in_category,
    percentile_in_category, rank_in_category <= 10 AS is_top_transaction FROM (SELECT *, RANK() OVER w AS rank_in_category,
      PERCENT_RANK() OVER w AS percentile_in_category FROM tx
      WINDOW w AS (PARTITION BY merchant_category ORDER BY amount DESC))""")
def _(spark, sf):
    return windows.rankings(tx(spark, sf)).select("transaction_id", "merchant_category", "amount", "rank_in_category",
                                                  "percentile_in_category", "is_top_transaction")


@query("rankings_without_category", """SELECT transaction_id, kind AS merchant_category, rank_in_category,
    percentile_in_category FROM (SELECT *, RANK() OVER w AS rank_in_category, PERCENT_RANK() OVER w AS percentile_in_category
      FROM (SELECT *, CASE WHEN timestamp_ms % 3 > 0 THEN merchant_category END AS kind FROM tx)
      WINDOW w AS (PARTITION BY kind ORDER BY amount DESC))""")
def _(spark, sf):
    """Ranks where a category can be missing: no row is lost."""
    kind = F.when(F.col("timestamp_ms") % 3 > 0, F.col("merchant_category"))
    return windows.rankings(tx(spark, sf).withColumn("merchant_category", kind)).select(
        "transaction_id", "merchant_category", "rank_in_category", "percentile_in_category")


@query("impossible_travel", f"""SELECT transaction_id, p_location AS prev_location, p_ms AS prev_timestamp_ms,
    CAST(timestamp_ms - p_ms AS DOUBLE) / 60000 AS minutes_since_prev, {FAST} AS impossible_travel FROM seq""")
def _(spark, sf):
    return windows.fraud_patterns(tx(spark, sf)).select("transaction_id", "prev_location", "prev_timestamp_ms",
                                                        "minutes_since_prev", "impossible_travel")


@query("travel_list", f"""SELECT customer_id, transaction_id, p_location AS prev_location,
    location AS current_location, CAST(timestamp_ms - p_ms AS DOUBLE) / 60000 AS minutes_between, amount
    FROM seq WHERE {FAST} ORDER BY minutes_between, transaction_id LIMIT 50""")
def _(spark, sf):
    return windows.travel_list(tx(spark, sf))


@query("card_testing_rows", f"""SELECT transaction_id, amount < 5 AS small_amount, k AS small_in_last5,
    k >= 3 AS card_testing FROM (SELECT *, COUNT(*) FILTER (WHERE amount < 5) OVER (
      {W_CUSTOMER} ROWS 4 PRECEDING) AS k FROM tx)""")
def _(spark, sf):
    return windows.fraud_patterns(tx(spark, sf)).select("transaction_id", "small_amount", "small_in_last5",
                                                        "card_testing")


@query("sql_velocity", f"""SELECT transaction_id, customer_id, amount, timestamp_ms, p_ms AS prev_timestamp_ms,
    CAST(timestamp_ms - p_ms AS DOUBLE) / 60000 AS minutes_since_prev, p_location AS prev_location, location,
    {FAST} AS impossible_travel, COUNT(*) OVER {HOUR_FRAME} AS tx_count_last_hour,
    {SUM_OVER.format(HOUR_FRAME)} AS amount_last_hour, rn AS tx_sequence FROM seq""")
def _(spark, sf):
    return windows.velocity_trace(tx(spark, sf))


@query("running_default_frame", f"""SELECT customer_id, transaction_id, rn AS tx_number, p_amount AS prev_amount,
    amount - p_amount AS amount_change,
    {SUM_OVER.format('(PARTITION BY customer_id ORDER BY timestamp_ms)')} AS cumulative_amount,
    COUNT(*) OVER (PARTITION BY customer_id) AS total_tx FROM seq""")
def _(spark, sf):
    return windows.running_with_ties(tx(spark, sf)).select(
        "customer_id", "transaction_id", "tx_number", "prev_amount", "amount_change", "cumulative_amount", "total_tx")


@query("sequence_minutes", f"""SELECT * FROM (SELECT customer_id, transaction_id, amount, rn AS tx_sequence,
    {SUM_OVER.format(f'({W_CUSTOMER} ROWS UNBOUNDED PRECEDING)')} AS cumulative_amount,
    COUNT(*) OVER (PARTITION BY customer_id) AS total_customer_tx, (timestamp_ms - p_ms) // 60000 AS minutes_since_last_tx
    FROM seq) WHERE total_customer_tx >= 5""")
def _(spark, sf):
    return windows.sequence(tx(spark, sf))


@query("sql_pattern_selfjoin", f"""SELECT a.customer_id, a.transaction_id AS first_tx, b.transaction_id AS second_tx,
    a.amount AS first_amount, b.amount AS second_amount, a.location AS first_location, b.location AS second_location,
    CAST(b.timestamp_ms - a.timestamp_ms AS DOUBLE) / 60000 AS minutes_between,
    CASE WHEN a.location <> b.location AND b.timestamp_ms - a.timestamp_ms < 1800000 THEN 'IMPOSSIBLE_TRAVEL'
      WHEN a.amount < 5 AND b.amount < 5 AND b.{C} > a.{C} THEN 'CARD_TESTING'
      WHEN b.{C} > a.{C} * 10 THEN 'SUDDEN_INCREASE' ELSE 'NORMAL' END AS pattern_type
    FROM seq a JOIN seq b ON a.customer_id = b.customer_id AND b.rn = a.rn + 1
    WHERE b.{C} > a.{C} * 10 OR (a.amount < 5 AND b.amount < 5)
      OR (a.location <> b.location AND b.timestamp_ms - a.timestamp_ms < 1800000)""")
def _(spark, sf):
    return windows.pattern_pairs(tx(spark, sf))


@query("tx_features", f"""SELECT transaction_id, velocity_score, CASE WHEN std > 0 THEN (amount - mean) / std ELSE 0.0 END
      AS amount_zscore, COALESCE(timestamp_ms - p_ms, 0) AS time_since_last_tx,
    COALESCE(amount / NULLIF(mean, 0), 1.0) AS avg_amount_ratio,
    COALESCE(location <> p_location, FALSE) AS location_changed,
    amount > 5000 OR merchant_category IN ('GAMBLING', 'CRYPTO', 'WIRE_TRANSFER') AS is_high_risk
    FROM (SELECT *, CASE WHEN n > 0 THEN s1::DOUBLE / 100 / n END AS mean,
        CASE WHEN n >= 2 THEN SQRT((n * s2 - s1 * s1)::DOUBLE / (n::DOUBLE * (n - 1))) / 100 END AS std
      FROM (SELECT *, COUNT(*) OVER {HOUR_FRAME} AS velocity_score, COUNT(*) OVER w AS n,
          COALESCE(SUM({C}) OVER w, 0) AS s1, COALESCE(SUM({C} * {C}) OVER w, 0) AS s2
        FROM seq WINDOW w AS ({W_CUSTOMER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))""")
def _(spark, sf):
    return windows.features(tx(spark, sf)).select(
        "transaction_id", "velocity_score", "amount_zscore", "time_since_last_tx", "avg_amount_ratio",
        "location_changed", "is_high_risk")


@query("join_profiles", """SELECT t.transaction_id, t.amount, p.avg_transaction_amount, p.max_transaction_amount,
    p.total_transactions, p.fraud_rate FROM tx t LEFT JOIN profile p USING (customer_id)""")
def _(spark, sf):
    rows = tx(spark, sf)
    return profiles.join_profiles(rows, profiles.customer_profiles(rows)).select(
        "transaction_id", "amount", "avg_transaction_amount", "max_transaction_amount", "total_transactions",
        "fraud_rate")


@query("zscore_population", f"""SELECT transaction_id, CASE WHEN s > 0 THEN (amount - m) / s ELSE 0.0 END AS amount_zscore
    FROM tx JOIN (SELECT customer_id, {MEAN} AS m, {STDEV_POP} AS s FROM tx GROUP BY customer_id) USING (customer_id)""")
def _(spark, sf):
    return profiles.zscore_population(tx(spark, sf)).select("transaction_id", "amount_zscore")


@query("sql_abnormal_customers", f"""SELECT *, CASE WHEN ABS(z_score) > 3 THEN 'EXTREME_OUTLIER' ELSE 'OUTLIER' END
      AS anomaly_status FROM (SELECT transaction_id, customer_id, amount, avg_amount, stddev_amount,
      (amount - avg_amount) / NULLIF(stddev_amount, 0) AS z_score FROM tx JOIN (SELECT customer_id, {MEAN} AS avg_amount,
        {STDEV} AS stddev_amount FROM tx GROUP BY customer_id HAVING {N} >= 3) USING (customer_id))
    WHERE ABS(z_score) > 2""")
def _(spark, sf):
    return profiles.abnormal_customers(tx(spark, sf))


HOURS = f"""(SELECT customer_id, {HOUR_START} AS hour, {N} AS tx_count, {TOTAL} AS total_amount,
    COUNT(DISTINCT location) AS unique_locations FROM tx GROUP BY 1, 2)"""


@query("velocity_vs_profile", f"""SELECT v.*, p.avg_transactions_per_day,
    v.tx_count / NULLIF(p.avg_transactions_per_day, 0) AS velocity_ratio
    FROM {HOURS} v LEFT JOIN profile p USING (customer_id) WHERE tx_count > 1 OR unique_locations > 3
    ORDER BY tx_count DESC, customer_id, hour LIMIT 100""")
def _(spark, sf):
    rows = tx(spark, sf)
    return profiles.velocity_vs_profile(rows, profiles.customer_profiles(rows), max_count=1, days=None)


@query("card_testing_hourly", f""", small AS (SELECT *, {HOUR_START} AS hour FROM tx WHERE amount < 5)
    SELECT customer_id, hour, n AS small_tx_count, total AS total_small_amount, transaction_id, merchant_category,
      channel FROM small JOIN (SELECT customer_id, hour, {N} AS n, {TOTAL} AS total FROM small GROUP BY 1, 2
      HAVING {N} >= 2) USING (customer_id, hour)""")
def _(spark, sf):
    return profiles.card_testing_hours(tx(spark, sf), min_rows=2)


@query("semi_in_subquery", f"""SELECT customer_id, transaction_id, amount, rn AS tx_num,
    {SUM_OVER.format('(PARTITION BY customer_id ORDER BY timestamp_ms)')} AS cumul_amount,
    COUNT(*) OVER (PARTITION BY customer_id) AS total_tx FROM seq WHERE customer_id IN (
      SELECT customer_id FROM tx GROUP BY customer_id HAVING {N} >= 3 ORDER BY customer_id LIMIT 3)""")
def _(spark, sf):
    return profiles.first_customers(tx(spark, sf))


@query("high_risk_customers", f"""SELECT r.*, p.fraud_count AS historical_frauds, p.fraud_rate AS historical_fraud_rate
    FROM (SELECT customer_id, {N} AS transaction_count, {TOTAL} AS total_amount, {SCORE} AS avg_fraud_score,
      {HITS} AS fraud_predictions FROM scored WHERE {DATE} >= {LAST_DAY} - 30 GROUP BY customer_id) r
    LEFT JOIN profile p USING (customer_id) WHERE avg_fraud_score > 0.5 OR p.fraud_rate > 0.01
    ORDER BY avg_fraud_score DESC, customer_id LIMIT 100""")
def _(spark, sf):
    return profiles.high_risk_customers(scored(spark, sf), profiles.customer_profiles(tx(spark, sf)))


@query("investigation_queue", f"""SELECT transaction_id, customer_id, amount, merchant_category, location, fraud_score,
    risk_level, p.fraud_count AS historical_frauds, p.avg_transaction_amount,
    amount / NULLIF(p.avg_transaction_amount, 0) AS amount_ratio FROM scored s LEFT JOIN profile p USING (customer_id)
    WHERE alert_required AND {DATE} >= {LAST_DAY} - 7
      AND (amount > 5000 OR amount / NULLIF(p.avg_transaction_amount, 0) > 5 OR p.fraud_count > 0)
    ORDER BY fraud_score DESC, transaction_id LIMIT 100""")
def _(spark, sf):
    return profiles.investigation_queue(scored(spark, sf), profiles.customer_profiles(tx(spark, sf)), days=7)

"""Aggregations and reports."""

from pyspark.sql import functions as F

from cardwatch.functions import times
from cardwatch.operators import aggregates as agg
from cardwatch.operators import dashboards as dash
from cardwatch.operators import profiles, quality, shape
from cardwatch.operators.timeline import Timeline
from cardwatch.plans.catalog import query, scored, tx, tx_balance
from cardwatch.plans.sql import (DATE, FRAUDS, HITS, HOUR, HOUR_START, LAST_DAY, MEAN, MEAN_CENT, N, SCORE, SCORE_4, STDEV,
                                 TOTAL, W_CUSTOMER, pct, rate, total_if)


@query("total_by_customer", f"SELECT customer_id, {TOTAL} AS total_amount FROM tx GROUP BY customer_id")
def _(spark, sf):
    return agg.total_by_customer(tx(spark, sf))


@query("group_rows", f"""SELECT customer_id, part, string_agg(transaction_id || '=' || {'amount'}, ';'
      ORDER BY timestamp_ms, transaction_id) AS "rows"
    FROM (SELECT *, (ROW_NUMBER() OVER ({W_CUSTOMER}) - 1) // 20 AS part FROM tx) GROUP BY customer_id, part""")
def _(spark, sf):
    grouped = agg.grouped_rows(tx(spark, sf), rows_per_group=20)
    text = F.transform("rows", lambda r: F.concat(r["transaction_id"], F.lit("="), r["amount"].cast("string")))
    return grouped.select("customer_id", "part", text.alias("rows"))


@query("merchant_stats", f"""SELECT merchant_id, {TOTAL} AS total_amount, MAX(amount) AS max_amount,
    {N} AS transaction_count FROM tx GROUP BY merchant_id""")
def _(spark, sf):
    return agg.merchant_stats(tx(spark, sf))


@query("count_by_location", f"SELECT location, {N} AS transaction_count FROM tx GROUP BY location")
def _(spark, sf):
    return agg.count_by(tx(spark, sf), "location")


@query("agg_customer", f"""SELECT customer_id, {N} AS transaction_count, {TOTAL} AS total_amount, {MEAN} AS avg_amount,
    MAX(amount) AS max_amount, MIN(amount) AS min_amount, {STDEV} AS stddev_amount, {FRAUDS} AS fraud_count,
    COUNT(DISTINCT merchant_id) AS unique_merchants, COUNT(DISTINCT location) AS unique_locations
    FROM tx GROUP BY customer_id""")
def _(spark, sf):
    return agg.by_customer(tx(spark, sf))


@query("agg_merchant", f"""SELECT merchant_id, merchant_category, {N} AS transaction_count, {TOTAL} AS total_revenue,
    {MEAN} AS avg_transaction_value, COUNT(DISTINCT customer_id) AS unique_customers, {rate(FRAUDS)} AS fraud_rate
    FROM tx GROUP BY merchant_id, merchant_category""")
def _(spark, sf):
    return agg.by_merchant(tx(spark, sf))


@query("sql_customer_agg", f"""SELECT customer_id, {N} AS total_transactions, {TOTAL} AS total_amount,
    {MEAN} AS avg_amount, MAX(amount) AS max_amount, MIN(amount) AS min_amount, {STDEV} AS stddev_amount,
    {FRAUDS} AS fraud_count, CAST({FRAUDS} * 100 AS DOUBLE) / {N} AS fraud_rate FROM tx GROUP BY customer_id
    HAVING {N} >= 5""")
def _(spark, sf):
    return agg.active_customers(tx(spark, sf))


@query("sql_category", f"""SELECT merchant_category, {N} AS transaction_count, {TOTAL} AS total_volume,
    {MEAN} AS avg_transaction, COUNT(DISTINCT customer_id) AS unique_customers, {FRAUDS} AS fraud_count,
    {pct(FRAUDS)} AS fraud_rate_percent FROM tx GROUP BY merchant_category""")
def _(spark, sf):
    return agg.by_category(tx(spark, sf))


@query("category_scored", f"""SELECT merchant_category, {N} AS tx_count, {TOTAL} AS volume, {MEAN_CENT} AS avg_amount,
    {FRAUDS} AS fraud_count, {pct(FRAUDS)} AS fraud_rate_pct, {SCORE} AS avg_score FROM scored
    GROUP BY merchant_category""")
def _(spark, sf):
    return agg.by_category_scored(scored(spark, sf))


@query("sql_hourly", f"""SELECT {HOUR} AS hour_of_day, {N} AS transaction_count, {TOTAL} AS total_amount,
    {MEAN} AS avg_amount, {FRAUDS} AS fraud_count, {pct(FRAUDS)} AS fraud_rate FROM tx GROUP BY 1""")
def _(spark, sf):
    return agg.by_hour_of_day(tx(spark, sf))


@query("hourly_periods", f"""SELECT hour, {N} AS tx_count, {TOTAL} AS volume, {FRAUDS} AS frauds,
    {pct(FRAUDS)} AS fraud_rate_pct, CASE WHEN hour <= 5 THEN 'Night' WHEN hour <= 11 THEN 'Morning'
    WHEN hour <= 17 THEN 'Afternoon' ELSE 'Evening' END AS time_period FROM enriched GROUP BY hour""")
def _(spark, sf):
    return agg.by_day_part(tx(spark, sf))


@query("hourly_predicted", f"""SELECT {HOUR} AS hour_of_day, {N} AS total_transactions, {HITS} AS fraud_count,
    CAST({HITS} * 100 AS DOUBLE) / {N} AS fraud_rate_percent, {TOTAL} AS total_volume,
    {total_if('is_fraud_predicted')} AS fraud_volume FROM scored GROUP BY 1""")
def _(spark, sf):
    return agg.predicted_by_hour(scored(spark, sf))


@query("sql_trend", f"""SELECT CAST({DATE} AS VARCHAR) AS date, {HOUR} AS hour, {N} AS transaction_count,
    {TOTAL} AS total_amount, {FRAUDS} AS fraud_count, CAST({FRAUDS} * 100 AS DOUBLE) / {N} AS fraud_rate
    FROM tx GROUP BY 1, 2""")
def _(spark, sf):
    return agg.trend(tx(spark, sf))


@query("customer_profile", f""", places AS (SELECT customer_id, string_agg(location, ';' ORDER BY r) AS preferred_locations
      FROM (SELECT customer_id, location, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY {N} DESC, location) AS r
        FROM tx GROUP BY customer_id, location) WHERE r <= 3 GROUP BY customer_id
    ), shops AS (SELECT customer_id, string_agg(merchant_id, ';' ORDER BY r) AS preferred_merchants
      FROM (SELECT customer_id, merchant_id, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY {N} DESC, merchant_id)
        AS r FROM tx GROUP BY customer_id, merchant_id) WHERE r <= 3 GROUP BY customer_id)
    SELECT * FROM profile JOIN places USING (customer_id) JOIN shops USING (customer_id)""")
def _(spark, sf):
    return profiles.customer_profiles(tx(spark, sf))


@query("merchant_risk", f"""SELECT *, CASE WHEN risk_score >= 0.1 THEN 'HIGH' WHEN risk_score >= 0.05 THEN 'MEDIUM'
      ELSE 'LOW' END AS risk_category FROM (SELECT merchant_id, merchant_category, {N} AS total_transactions,
      {TOTAL} AS total_volume, {FRAUDS} AS fraud_count, {total_if('is_fraud')} AS fraud_volume,
      {rate(FRAUDS)} AS fraud_rate, ({FRAUDS} + 0.4::DOUBLE) / ({N} + 20) AS risk_score
      FROM tx GROUP BY merchant_id, merchant_category)""")
def _(spark, sf):
    return profiles.merchant_risk(tx(spark, sf))


@query("hourly_metrics", f"""SELECT {HOUR_START} AS metric_hour, {N} AS total_transactions, {TOTAL} AS total_volume,
    {MEAN} AS avg_amount, {HITS} AS fraud_count, {total_if('is_fraud_predicted')} AS fraud_volume,
    {rate(HITS)} AS fraud_rate, COUNT(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_alerts,
    COUNT(*) FILTER (WHERE risk_level = 'HIGH') AS high_alerts, COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(DISTINCT merchant_id) AS unique_merchants FROM scored GROUP BY 1""")
def _(spark, sf):
    return profiles.hourly_metrics(scored(spark, sf)).drop("avg_latency_ms")


@query("global_stats", f"""SELECT {N} AS total_transactions, {TOTAL} AS total_amount, {MEAN} AS avg_amount,
    MAX(amount) AS max_amount, MIN(amount) AS min_amount, {FRAUDS} AS fraud_count, {rate(FRAUDS)} AS fraud_rate
    FROM tx""")
def _(spark, sf):
    return agg.global_stats(tx(spark, sf))


@query("sql_dashboard", f"""SELECT {N} AS total_transactions, {TOTAL} AS total_volume, {MEAN} AS avg_transaction_amount,
    COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT merchant_id) AS unique_merchants,
    {FRAUDS} AS total_frauds, {pct(FRAUDS, N, 4)} AS fraud_rate_percent, {total_if('is_fraud')} AS fraud_volume
    FROM tx""")
def _(spark, sf):
    return dash.overview(tx(spark, sf))


@query("dashboard_scored", f"""SELECT {N} AS total_transactions, COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(DISTINCT merchant_id) AS unique_merchants, {TOTAL} AS total_volume, {MEAN_CENT} AS avg_transaction,
    MAX(amount) AS max_transaction, {FRAUDS} AS actual_frauds, {HITS} AS predicted_frauds,
    COUNT(*) FILTER (WHERE alert_required) AS alerts_generated FROM scored""")
def _(spark, sf):
    return dash.overview_scored(scored(spark, sf))


def _fraud_merchants(source, hit, having, n):
    f = f"COUNT(*) FILTER (WHERE {hit})"
    return f"""SELECT merchant_id, merchant_category, {N} AS total_transactions, {TOTAL} AS total_volume,
        {f} AS fraud_count, {total_if(hit)} AS fraud_volume, {pct(f)} AS fraud_rate FROM {source}
        GROUP BY merchant_id, merchant_category HAVING {having}
        ORDER BY fraud_rate DESC, fraud_volume DESC, merchant_id LIMIT {n}"""


@query("sql_top_fraud_merchants", _fraud_merchants("tx", "is_fraud", f"{FRAUDS} > 0", 20))
def _(spark, sf):
    return dash.top_fraud_merchants(tx(spark, sf))


@query("top_fraud_merchants_large", _fraud_merchants("scored", "is_fraud_predicted", f"{N} >= 100", 50))
def _(spark, sf):
    return dash.top_fraud_merchants(scored(spark, sf), "is_fraud_predicted", min_rows=100, min_frauds=0, n=50)


def _cube(source, keys, measures, flags=False):
    labels = [f"CASE WHEN GROUPING({k}) = 1 THEN 'ALL' ELSE {k} END AS {k}" for k in keys]
    extra = [f"GROUPING({k}) AS all_{k}" for k in keys] if flags else []
    return f"SELECT {', '.join(labels + measures + extra)} FROM {source} GROUP BY CUBE ({', '.join(keys)})"


@query("sql_cube", _cube("tx", ("merchant_category", "channel", "card_type"), [
    f"{N} AS transaction_count", f"{TOTAL} AS total_amount", f"{MEAN} AS avg_amount", f"{FRAUDS} AS fraud_count"]))
def _(spark, sf):
    return agg.cube_by_channel(tx(spark, sf))


@query("cube_grouping_order", _cube("scored", ("merchant_category", "channel", "risk_level"), [
    f"{N} AS transaction_count", f"{TOTAL} AS total_volume", f"{SCORE} AS avg_fraud_score"], flags=True))
def _(spark, sf):
    return agg.cube_by_risk(scored(spark, sf))


@query("percentiles", f"""SELECT merchant_category, {', '.join(f"quantile_disc(amount, {q}) AS {name}"
    for name, q in agg.QUANTILES.items())}, MAX(amount) AS max_amount FROM tx GROUP BY merchant_category""")
def _(spark, sf):
    return agg.percentiles_exact(tx(spark, sf))


@query("percentiles_exact", f"""SELECT merchant_category, {', '.join(
    f"MIN(CASE WHEN r >= (n * {round(q * 100)} + 99) // 100 THEN amount END) AS {name}" for name, q in agg.QUANTILES.items())},
    MAX(amount) AS max_amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY merchant_category ORDER BY amount) AS r,
      COUNT(*) OVER (PARTITION BY merchant_category) AS n FROM tx) GROUP BY merchant_category""")
def _(spark, sf):
    return agg.percentiles_exact(tx(spark, sf))


@query("percentiles_without_category", f"""SELECT CASE WHEN timestamp_ms % 3 > 0 THEN merchant_category END AS merchant_category,
    {', '.join(f"quantile_disc(amount, {q}) AS {name}" for name, q in agg.QUANTILES.items())}, MAX(amount) AS max_amount
    FROM tx GROUP BY 1""")
def _(spark, sf):
    """Exact percentiles where a category can be missing."""
    return agg.percentiles_exact(tx(spark, sf).withColumn("merchant_category", F.when(F.col("timestamp_ms") % 3 > 0, F.col("merchant_category"))))


@query("segment_analysis", f"""SELECT merchant_category, channel, risk_level, {N} AS transaction_count,
    {TOTAL} AS total_volume, {MEAN} AS avg_amount, {HITS} AS fraud_count, {SCORE} AS avg_fraud_score,
    quantile_disc(amount, 0.5) AS median_amount, quantile_disc(amount, 0.95) AS p95_amount FROM scored
    GROUP BY merchant_category, channel, risk_level""")
def _(spark, sf):
    return agg.segments(scored(spark, sf))


@query("minute_metrics", f"""SELECT timestamp_ms // 60000 * 60000 AS minute, {N} AS transactions, {TOTAL} AS volume,
    {HITS} AS frauds, {SCORE} AS avg_score FROM scored
    WHERE timestamp_ms > (SELECT MAX(timestamp_ms) FROM tx) - 3600000 GROUP BY 1""")
def _(spark, sf):
    return dash.minute_metrics(scored(spark, sf))


@query("open_alerts", f"""SELECT alert_level, {N} AS alert_count, {SCORE} AS avg_score, {TOTAL} AS total_amount FROM alerts
    WHERE {DATE} >= (SELECT MAX({DATE}) FROM alerts) - 1 GROUP BY alert_level""")
def _(spark, sf):
    return dash.open_alerts(profiles.alert_events(scored(spark, sf)))


@query("alerts_by_risk", f"""SELECT risk_level, {N} AS alert_count, {TOTAL} AS total_amount, {MEAN_CENT} AS avg_amount,
    {SCORE_4} AS avg_fraud_score, COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(DISTINCT merchant_id) AS unique_merchants FROM scored WHERE alert_required GROUP BY risk_level""")
def _(spark, sf):
    return dash.alert_summary(scored(spark, sf))


@query("alert_counts", f"SELECT alert_level, {N} AS alert_count FROM alerts GROUP BY alert_level")
def _(spark, sf):
    return quality.alert_counts(profiles.alert_events(scored(spark, sf)))


@query("hourly_velocity", f"""SELECT customer_id, {HOUR_START} AS hour, {N} AS tx_count, {TOTAL} AS total_amount,
    COUNT(DISTINCT location) AS unique_locations FROM tx GROUP BY 1, 2""")
def _(spark, sf):
    return agg.hourly_velocity(tx(spark, sf))


@query("daily_summary", f"""SELECT CAST({DATE} AS VARCHAR) AS transaction_date, {N} AS total_transactions,
    {TOTAL} AS total_volume, {HITS} AS fraud_count, {total_if('is_fraud_predicted')} AS fraud_volume,
    {SCORE} AS avg_fraud_score, COUNT(DISTINCT customer_id) AS unique_customers FROM scored
    WHERE {DATE} >= {LAST_DAY} - 7 GROUP BY 1""")
def _(spark, sf):
    return dash.daily_summary(scored(spark, sf))


@query("category_risk", f"""SELECT merchant_category, risk_level, {N} AS transaction_count, {TOTAL} AS total_volume,
    {MEAN} AS avg_amount, {SCORE} AS avg_fraud_score, {HITS} AS fraud_count FROM scored
    WHERE {DATE} >= {LAST_DAY} - 7 GROUP BY 1, 2""")
def _(spark, sf):
    return dash.category_risk(scored(spark, sf))


@query("model_daily", f"""SELECT CAST({DATE} AS VARCHAR) AS prediction_date, 'rules-1' AS model_version,
    {N} AS total_predictions, {HITS} AS fraud_predictions, {SCORE} AS avg_probability,
    MAX(fraud_score) AS max_probability FROM scored WHERE {DATE} >= {LAST_DAY} - 30 GROUP BY 1""")
def _(spark, sf):
    return dash.model_daily(profiles.predictions(scored(spark, sf)))


@query("geo_analysis", f"""SELECT location, country, {N} AS tx_count, {TOTAL} AS volume,
    COUNT(*) FILTER (WHERE is_international) AS international_tx, {FRAUDS} AS frauds, {pct(FRAUDS)} AS fraud_rate_pct,
    {SCORE} AS avg_fraud_score FROM scored GROUP BY location, country""")
def _(spark, sf):
    return agg.geography(scored(spark, sf))


def _cells(guess):
    cells = {"tp": f"{guess} AND is_fraud", "fp": f"{guess} AND NOT is_fraud", "fn": f"NOT ({guess}) AND is_fraud",
             "tn": f"NOT ({guess}) AND NOT is_fraud"}
    return {k: f"COUNT(*) FILTER (WHERE {v})" for k, v in cells.items()}


def _confusion(guess):
    c = _cells(guess)
    tp, fp, fn = c["tp"], c["fp"], c["fn"]
    return f"""{tp} AS true_positives, {fp} AS false_positives, {fn} AS false_negatives, {c['tn']} AS true_negatives,
        {rate(tp, f'({tp} + {fp})')} AS "precision", {rate(tp, f'({tp} + {fn})')} AS recall,
        {rate(f'(2 * {tp})', f'(2 * {tp} + {fp} + {fn})')} AS f1"""


@query("confusion", f"SELECT {_confusion('is_fraud_predicted')} FROM scored")
def _(spark, sf):
    return dash.confusion(scored(spark, sf))


@query("confusion_daily", f"""SELECT CAST({DATE} AS VARCHAR) AS prediction_date, {_confusion('score_points >= 70')}
    FROM scored GROUP BY 1""")
def _(spark, sf):
    return dash.confusion_by_day(scored(spark, sf))


@query("confusion_by_level", f"""SELECT risk_level, {N} AS total_count, {FRAUDS} AS actual_frauds,
    {HITS} AS predicted_frauds, {_cells('is_fraud_predicted')['tp']} AS true_positives,
    {_cells('is_fraud_predicted')['fp']} AS false_positives, {_cells('is_fraud_predicted')['fn']} AS false_negatives,
    {_cells('is_fraud_predicted')['tn']} AS true_negatives, {SCORE_4} AS avg_fraud_score
    FROM scored GROUP BY risk_level""")
def _(spark, sf):
    return dash.model_by_level(scored(spark, sf))


@query("pr_curve", f"""SELECT t::DOUBLE / 100 AS threshold, {N} AS total,
    COUNT(*) FILTER (WHERE score_points >= t) AS predicted_positive,
    COUNT(*) FILTER (WHERE is_fraud AND score_points >= t) AS true_positive,
    {rate('COUNT(*) FILTER (WHERE is_fraud AND score_points >= t)', 'COUNT(*) FILTER (WHERE score_points >= t)')}
      AS "precision", {rate('COUNT(*) FILTER (WHERE is_fraud AND score_points >= t)', FRAUDS)} AS recall
    FROM scored, (SELECT UNNEST(range(10, 100, 10)) AS t) GROUP BY t""")
def _(spark, sf):
    return dash.precision_recall(scored(spark, sf))


def _corr(name, x):
    sx, sy, sxy, sxx = f"SUM({x})", "SUM(y)", f"SUM({x} * y)", f"SUM({x} * {x})"
    return f"""SELECT '{name}' AS feature, CAST({N} * {sxy} - {sx} * {sy} AS DOUBLE) / NULLIF(
        SQRT(CAST({N} * {sxx} - {sx} * {sx} AS DOUBLE)) * SQRT(CAST({N} * {sy} - {sy} * {sy} AS DOUBLE)), 0)
        AS correlation FROM numbers"""


@query("feature_corr", f""", numbers AS (SELECT amount_cents, CAST(is_international AS BIGINT) AS abroad,
      CAST(ROUND(previous_balance * 100) AS BIGINT) AS balance,
      CASE WHEN is_fraud_predicted THEN 1::BIGINT ELSE 0 END AS y FROM scored)
    {_corr('amount', 'amount_cents')} UNION ALL {_corr('is_international', 'abroad')}
    UNION ALL {_corr('previous_balance', 'balance')}""")
def _(spark, sf):
    from cardwatch.functions import numbers, rules
    rows = rules.apply(shape.enrich(tx_balance(spark, sf)), rules.stream_rules())
    return dash.correlations(rows, {"amount": F.col("amount_cents"), "is_international": F.col("is_international"),
                                    "previous_balance": numbers.cents("previous_balance")})


@query("score_deciles", f"""SELECT decile, MIN(fraud_score) AS min_score, MAX(fraud_score) AS max_score,
    {N} AS transaction_count, {HITS} AS actual_frauds FROM (SELECT *, NTILE(10) OVER (
      ORDER BY score_points, timestamp_ms, transaction_id) AS decile FROM scored) GROUP BY decile""")
def _(spark, sf):
    return dash.score_deciles(scored(spark, sf))


SHARE = f"""SELECT risk_level, {N} AS transaction_count, {TOTAL} AS total_amount, {SCORE_4} AS avg_fraud_score,
    {FRAUDS} AS actual_frauds, {pct(N, '(SELECT COUNT(*) FROM tx)')} AS percentage FROM scored GROUP BY risk_level"""


@query("risk_share_window", SHARE)
def _(spark, sf):
    return dash.risk_share(scored(spark, sf))


@query("risk_share_subquery", SHARE)
def _(spark, sf):
    return dash.risk_share(scored(spark, sf), by_subquery=True)


@query("risk_distribution", f"SELECT risk_level, {N} AS transaction_count FROM scored GROUP BY risk_level")
def _(spark, sf):
    return dash.risk_distribution(scored(spark, sf))


@query("eod_report", f"""SELECT {N} AS total_transactions, {TOTAL} AS total_volume, {HITS} AS frauds_detected,
    {total_if('is_fraud_predicted')} AS fraud_volume_blocked, {SCORE} AS avg_fraud_score,
    COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(*) FILTER (WHERE risk_level = 'CRITICAL') AS critical_transactions FROM scored WHERE {DATE} >= {LAST_DAY}""")
def _(spark, sf):
    return dash.end_of_day(scored(spark, sf))


@query("eod_top_categories", f"""SELECT merchant_category, {HITS} AS frauds, {N} AS transactions FROM scored
    WHERE {DATE} >= {LAST_DAY} GROUP BY 1 ORDER BY frauds DESC, transactions DESC, merchant_category LIMIT 3""")
def _(spark, sf):
    return dash.top_categories(scored(spark, sf))


@query("risky_customers", f"""SELECT *, ROW_NUMBER() OVER (ORDER BY avg_fraud_score DESC, customer_id) AS risk_rank
    FROM (SELECT customer_id, {N} AS total_transactions, {TOTAL} AS total_spent, {MEAN_CENT} AS avg_transaction,
      {SCORE_4} AS avg_fraud_score, {FRAUDS} AS fraud_count, COUNT(*) FILTER (WHERE alert_required) AS alert_count
      FROM scored GROUP BY customer_id HAVING {N} >= 3) ORDER BY risk_rank LIMIT 20""")
def _(spark, sf):
    return dash.risky_customers(scored(spark, sf))


@query("top_customers", f"""SELECT customer_id, {TOTAL} AS total_amount FROM tx GROUP BY customer_id
    ORDER BY total_amount DESC, customer_id LIMIT 10""")
def _(spark, sf):
    return agg.top_customers(tx(spark, sf))


@query("max_bucket_velocity", f"""SELECT customer_id, MAX(n) AS max_tx_in_slot FROM (SELECT customer_id, {N} AS n
    FROM tx GROUP BY customer_id, timestamp_ms // 3600000) GROUP BY customer_id""")
def _(spark, sf):
    return agg.busiest_slot(tx(spark, sf))


def _bin(x, high, bins):
    return (f"CASE WHEN {x} >= {high} THEN {bins + 1} ELSE CAST(FLOOR({x}::DOUBLE * {bins} / {high}) AS BIGINT) + 1 END")


@query("histograms", f"""SELECT 'amount' AS chart, CAST({_bin('amount', 20000, 50)} AS VARCHAR) AS label,
      {N} AS row_count FROM scored GROUP BY 2
    UNION ALL SELECT 'score', CAST({_bin('score_points', 120, 30)} AS VARCHAR), {N} FROM scored GROUP BY 2
    UNION ALL SELECT 'category', merchant_category, {N} FROM scored GROUP BY 2
    UNION ALL SELECT 'risk', risk_level, {N} FROM scored GROUP BY 2""")
def _(spark, sf):
    return dash.chart_data(scored(spark, sf))


@query("week_over_week", f""", daily AS (SELECT {DATE} AS d, {N} AS n, {HITS} AS f FROM scored GROUP BY 1)
    SELECT CAST(a.d AS VARCHAR) AS date, a.n AS current_transactions, a.f AS current_frauds,
      b.n AS prev_week_transactions, b.f AS prev_week_frauds,
      CAST((a.n - b.n) * 100 AS DOUBLE) / NULLIF(b.n, 0) AS tx_change_percent,
      CAST((a.f - b.f) * 100 AS DOUBLE) / NULLIF(b.f, 0) AS fraud_change_percent
    FROM daily a LEFT JOIN daily b ON a.d = b.d + 7 WHERE a.d >= {LAST_DAY} - 14""")
def _(spark, sf):
    return dash.week_over_week(scored(spark, sf))


@query("moving_avg_7d", f""", daily AS (SELECT {DATE} AS d, {N} AS n, {TOTAL} AS v, {FRAUDS} AS f,
      COUNT(*) FILTER (WHERE alert_required) AS a, {SCORE_4} AS s FROM scored GROUP BY 1)
    SELECT CAST(d AS VARCHAR) AS transaction_date, n AS daily_transactions, v AS daily_volume, f AS daily_frauds,
      a AS daily_alerts, s AS avg_fraud_score,
      CAST((2 * SUM(n) OVER w + COUNT(*) OVER w) // (2 * COUNT(*) OVER w) AS BIGINT) AS moving_avg_tx
    FROM daily WINDOW w AS (ORDER BY d ROWS 6 PRECEDING)""")
def _(spark, sf):
    return dash.moving_average(scored(spark, sf))


@query("quality_metrics", f"""SELECT {N} AS total_rows, 0.0::DOUBLE AS null_rate,
    CAST({N} - COUNT(DISTINCT transaction_id) AS DOUBLE) / {N} AS duplicate_rate, TRUE AS schema_valid,
    {N} = COUNT(DISTINCT transaction_id) AS passed FROM tx""")
def _(spark, sf):
    return quality.quality(tx_balance(spark, sf))


@query("quality_metrics_union", f""", twice AS (SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE amount > 1000)
    SELECT {N} AS total_rows, CAST(COUNT(*) FILTER (WHERE device_id IS NULL) AS DOUBLE) / {N} AS null_rate,
      CAST({N} - COUNT(DISTINCT transaction_id) AS DOUBLE) / {N} AS duplicate_rate, TRUE AS schema_valid,
      FALSE AS passed FROM twice""")
def _(spark, sf):
    """Quality figures where there are repeated ids and missing devices."""
    rows = tx(spark, sf)
    return quality.quality(shape.union_batches([rows, shape.high_value(rows)]), ("transaction_id", "device_id"))


@query("union_batches", f"""SELECT CAST({DATE} AS VARCHAR) AS date, {N} AS transaction_count FROM tx GROUP BY 1""")
def _(spark, sf):
    """Batches of even and odd hours put together again."""
    rows = tx(spark, sf)
    odd = times.hour_of_day() % 2 == 1
    both = shape.union_batches([rows.where(odd), rows.where(~odd)])
    return both.groupBy(times.event_date().alias("date")).agg(F.count("*").alias("transaction_count"))

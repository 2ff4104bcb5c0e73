"""Projections, filters, derived columns, rule scores."""

from pyspark.sql import functions as F

from cardwatch.functions import rules
from cardwatch.operators import dashboards, generate, profiles, quality, shape, windows
from cardwatch.plans.catalog import flat, history_of, query, scored, tx, tx_balance
from cardwatch.plans.sql import DATE, HISTORY, HOUR, MEAN, FRAUDS, RISKY, WIRE, W_CUSTOMER, flags, level
from cardwatch.sources import tables

BAND = "CASE WHEN amount < {} THEN 'LOW' WHEN amount < {} THEN 'MEDIUM' WHEN amount < {} THEN 'HIGH' ELSE 'VERY_HIGH' END"
BAND_A, BAND_B = BAND.format(100, 1000, 5000), BAND.format(100, 500, 2000)


@query("normalized", """SELECT transaction_id, customer_id, merchant_id, amount, currency, transaction_type, channel,
    location, device_id, ip_address, timestamp_ms, card_type, is_international, merchant_category, previous_balance,
    is_fraud FROM tx""")
def _(spark, sf):
    return tx_balance(spark, sf).drop("amount_cents", "country")


@query("select_basic", "SELECT transaction_id, customer_id, amount, timestamp_ms, is_fraud FROM tx")
def _(spark, sf):
    return shape.basic_info(tx(spark, sf))


@query("extract_amounts", "SELECT amount FROM tx")
def _(spark, sf):
    return shape.amounts(tx(spark, sf))


@query("customer_locations", "SELECT DISTINCT customer_id, location FROM tx")
def _(spark, sf):
    return shape.customer_locations(tx(spark, sf), unique=True)


@query("customer_location_pairs", "SELECT customer_id, location FROM tx")
def _(spark, sf):
    return shape.customer_locations(tx(spark, sf))


@query("filter_high_value", "SELECT transaction_id, customer_id, amount FROM tx WHERE amount > 1000")
def _(spark, sf):
    return shape.high_value(tx(spark, sf)).select("transaction_id", "customer_id", "amount")


@query("filter_high_risk", f"""SELECT transaction_id, amount, is_international, merchant_category FROM tx
    WHERE amount > 5000 OR merchant_category IN {WIRE} OR (amount > 1000 AND is_international)""")
def _(spark, sf):
    return shape.high_risk(tx(spark, sf)).select("transaction_id", "amount", "is_international", "merchant_category")


@query("derived_columns", f"""SELECT transaction_id, hour, day_of_week, amount > 5000 AS is_high_amount,
    CASE WHEN amount > 10000 THEN 0.8::DOUBLE WHEN amount > 5000 THEN 0.5 WHEN is_international AND amount > 1000
    THEN 0.4 ELSE 0.1 END AS risk_score, {BAND_A} AS amount_category FROM enriched""")
def _(spark, sf):
    return shape.derive(tx(spark, sf)).select("transaction_id", "hour", "day_of_week", "is_high_amount", "risk_score",
                                              "amount_category")


@query("derived_columns_additive", f"""SELECT transaction_id, hour, amount > 1000 AS is_high_amount,
    {BAND_B} AS amount_category, CAST(CASE WHEN amount > 5000 THEN 40 ELSE 0 END
    + CASE WHEN merchant_category IN {RISKY} THEN 30 ELSE 0 END
    + CASE WHEN is_international AND amount > 1000 THEN 20 ELSE 0 END AS DOUBLE) / 100 AS risk_score FROM enriched""")
def _(spark, sf):
    return shape.derive_additive(tx(spark, sf)).select("transaction_id", "hour", "is_high_amount", "amount_category",
                                                       "risk_score")


FLAGS = ("transaction_id", "hour", "day_of_week", "is_weekend", "is_suspicious_hour", "amount_category",
         "is_risky_merchant")


@query("enrich_stream_features", f"""SELECT transaction_id, hour, day_of_week, is_weekend, is_suspicious_hour,
    {BAND_A} AS amount_category, merchant_category IN {WIRE} AS is_risky_merchant FROM enriched""")
def _(spark, sf):
    return shape.enrich(tx(spark, sf)).select(*FLAGS)


@query("enrich_notebook", f"""SELECT transaction_id, hour, day_of_week, is_weekend, is_suspicious_hour,
    {BAND_B} AS amount_category, merchant_category IN {RISKY} AS is_risky_merchant FROM enriched""")
def _(spark, sf):
    return shape.enrich_notebook(tx(spark, sf)).select(*FLAGS)


RATIO = "CASE WHEN previous_balance > 0 THEN amount / previous_balance ELSE 1.0 END"


@query("enrich_balance_ratio", f"""SELECT transaction_id, timestamp_ms AS transaction_time, hour, is_suspicious_hour,
    amount > 5000 AS is_high_amount, {RATIO} AS amount_to_balance_ratio,
    CASE WHEN amount < 50 THEN 'MICRO' WHEN amount < 200 THEN 'LOW' WHEN amount < 1000 THEN 'MEDIUM'
    WHEN amount < 5000 THEN 'HIGH' ELSE 'VERY_HIGH' END AS amount_category FROM enriched""")
def _(spark, sf):
    return shape.enrich_balance(tx_balance(spark, sf)).select(
        "transaction_id", "transaction_time", "hour", "is_suspicious_hour", "is_high_amount",
        "amount_to_balance_ratio", "amount_category")


@query("partition_columns", f"SELECT transaction_id, CAST({DATE} AS VARCHAR) AS transaction_date FROM tx")
def _(spark, sf):
    return shape.with_dates(tx(spark, sf)).select("transaction_id", "transaction_date")


@query("sql_basic_select", """SELECT transaction_id, customer_id, amount, merchant_category, is_international, is_fraud
    FROM tx WHERE amount > 1000 ORDER BY amount DESC, transaction_id LIMIT 100""")
def _(spark, sf):
    return shape.largest(tx(spark, sf))


@query("alerts_filter", "SELECT transaction_id, fraud_score, risk_level FROM scored WHERE score_points >= 50")
def _(spark, sf):
    return shape.alerts_only(scored(spark, sf)).select("transaction_id", "fraud_score", "risk_level")


@query("fill_missing", """SELECT transaction_id, COALESCE(previous_balance, 0) AS previous_balance,
    COALESCE(device_id, 'UNKNOWN') AS device_id, COALESCE(ip_address, 'UNKNOWN') AS ip_address FROM tx""")
def _(spark, sf):
    return shape.fill_missing(tx_balance(spark, sf), ["previous_balance"], ["device_id", "ip_address"]).select(
        "transaction_id", "previous_balance", "device_id", "ip_address")


@query("cast_flags", """SELECT transaction_id, CAST(is_fraud AS DOUBLE) AS is_fraud_num,
    CAST(is_international AS BIGINT) AS is_international_num FROM tx""")
def _(spark, sf):
    return shape.flags_to_numbers(tx(spark, sf), is_fraud="double", is_international="int").select(
        "transaction_id", "is_fraud_num", "is_international_num")


REASONS = f"""concat_ws(';', CASE WHEN amount > 5000 THEN 'HIGH_AMOUNT: ' || amount END,
    CASE WHEN is_international AND amount > 1000 THEN 'HIGH_INTERNATIONAL_TX' END,
    CASE WHEN is_suspicious_hour THEN 'SUSPICIOUS_HOUR: ' || hour END,
    CASE WHEN merchant_category IN {WIRE} THEN 'RISKY_MERCHANT_CATEGORY: ' || merchant_category END)"""


@query("suspicious_reasons", f"""SELECT * FROM (SELECT transaction_id, customer_id, amount, {REASONS} AS reasons
    FROM enriched) WHERE reasons <> ''""")
def _(spark, sf):
    return profiles.suspicious(tx(spark, sf)).select("transaction_id", "customer_id", "amount", "reasons")


@query("suspicious_reasons_short", f"""SELECT * FROM (SELECT transaction_id, concat_ws(';', 
    CASE WHEN amount > 5000 THEN printf('HIGH_AMOUNT: %.2f€', amount) END,
    CASE WHEN merchant_category IN {RISKY} THEN 'RISKY_CATEGORY: ' || merchant_category END,
    CASE WHEN is_international AND amount > 1000 THEN 'HIGH_INTERNATIONAL' END) AS reasons
    FROM tx) WHERE reasons <> ''""")
def _(spark, sf):
    return profiles.suspicious_short(tx(spark, sf)).select("transaction_id", "reasons")


# Mean and deviation over strictly earlier rows, from running sums of cents.
EARLIER = f"""history AS (
  SELECT *, CASE WHEN n > 0 THEN s1::DOUBLE / 100 / n END AS historical_avg,
    CASE WHEN n >= 2 THEN SQRT((n * s2 - s1 * s1)::DOUBLE / (n::DOUBLE * (n - 1))) / 100 END AS historical_std
  FROM (SELECT *, COUNT(*) OVER w AS n, COALESCE(SUM(amount_cents) OVER w, 0) AS s1,
          COALESCE(SUM(amount_cents * amount_cents) OVER w, 0) AS s2 FROM enriched
        WINDOW w AS ({W_CUSTOMER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), z AS (SELECT *, CASE WHEN historical_std > 0 THEN (amount - historical_avg) / historical_std ELSE 0.0 END
  AS amount_zscore FROM history)"""


@query("historical_zscore", f""", {EARLIER} SELECT transaction_id, historical_avg, historical_std, amount_zscore FROM z""")
def _(spark, sf):
    return windows.history(tx(spark, sf)).select("transaction_id", "historical_avg", "historical_std",
                                                 "amount_zscore")


SCORED = ("transaction_id", "score_points", "fraud_score", "risk_level", "is_fraud_predicted", "alert_required")
BATCH_POINTS = f"""(CASE WHEN ABS(amount_zscore) > 3 THEN 40 ELSE 0 END
    + CASE WHEN amount > 5000 THEN 20 WHEN amount > 1000 THEN 10 ELSE 0 END
    + CASE WHEN is_international THEN 15 ELSE 0 END + CASE WHEN merchant_category IN {RISKY} THEN 20 ELSE 0 END
    + CASE WHEN is_suspicious_hour THEN 15 ELSE 0 END)"""


@query("fraud_score_batch", f", {EARLIER} SELECT transaction_id, {flags(BATCH_POINTS)} FROM z")
def _(spark, sf):
    return windows.batch_score(tx(spark, sf)).select(*SCORED)


@query("fraud_score_stream_rules", f"SELECT {', '.join(SCORED)} FROM scored")
def _(spark, sf):
    return scored(spark, sf).select(*SCORED)


CLOUD_POINTS = f"""(CASE WHEN amount > 10000 THEN 50 WHEN amount > 5000 THEN 30 WHEN amount > 2000 THEN 15 ELSE 0 END
    + CASE WHEN merchant_category IN {RISKY} THEN 30 ELSE 0 END + CASE WHEN is_suspicious_hour THEN 15 ELSE 0 END
    + CASE WHEN is_international AND amount > 1000 THEN 25 ELSE 0 END
    + CASE WHEN {RATIO} > 0.8 THEN 20 ELSE 0 END)"""


@query("fraud_score_cloud", f"SELECT transaction_id, {flags(CLOUD_POINTS)} FROM enriched")
def _(spark, sf):
    return rules.apply(shape.enrich_balance(tx_balance(spark, sf)), rules.CLOUD).select(*SCORED)


NOTEBOOK_POINTS = f"""(CASE WHEN amount > 10000 THEN 50 WHEN amount > 5000 THEN 30 ELSE 0 END
    + CASE WHEN merchant_category IN {RISKY} THEN 30 ELSE 0 END + CASE WHEN is_suspicious_hour THEN 15 ELSE 0 END
    + CASE WHEN is_international AND amount > 1000 THEN 20 ELSE 0 END)"""


@query("fraud_score_notebook", f"SELECT transaction_id, {flags(NOTEBOOK_POINTS)} FROM enriched")
def _(spark, sf):
    return rules.apply(shape.enrich_notebook(tx(spark, sf)), rules.NOTEBOOK).select(*SCORED)


@query("sql_high_risk", f"""SELECT transaction_id, customer_id, amount, merchant_category, location, is_international,
    hour, CASE WHEN amount > 10000 THEN 'VERY_HIGH_AMOUNT' WHEN amount > 5000 THEN 'HIGH_AMOUNT'
      WHEN is_international AND amount > 1000 THEN 'HIGH_INTERNATIONAL' WHEN merchant_category IN {WIRE}
      THEN 'RISKY_MERCHANT' WHEN is_suspicious_hour THEN 'SUSPICIOUS_HOUR' ELSE 'NORMAL' END AS risk_reason,
    CASE WHEN merchant_category IN {RISKY} OR amount > 10000 OR (amount > 5000 AND is_international) THEN 'CRITICAL'
      WHEN is_suspicious_hour OR amount > 5000 OR (amount > 1000 AND is_international) THEN 'HIGH'
      WHEN amount > 1000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
    FROM enriched WHERE is_suspicious_hour OR is_international OR amount > 1000 OR merchant_category IN {WIRE}""")
def _(spark, sf):
    return dashboards.high_risk_list(tx(spark, sf))


@query("sql_high_risk_short", f"""SELECT transaction_id, customer_id, amount, merchant_category,
    CASE WHEN amount > 5000 THEN 'VERY_HIGH_AMOUNT' WHEN merchant_category IN {RISKY} THEN 'RISKY_MERCHANT'
      WHEN is_international AND amount > 1000 THEN 'HIGH_INTERNATIONAL' ELSE 'NORMAL' END AS risk_reason,
    CASE WHEN merchant_category IN {RISKY} OR amount > 5000 THEN 'HIGH' WHEN amount > 1000 THEN 'MEDIUM' ELSE 'LOW' END
      AS risk_level, is_fraud FROM tx WHERE merchant_category IN {RISKY} OR amount > 1000
    ORDER BY amount DESC, transaction_id LIMIT 15""")
def _(spark, sf):
    return dashboards.high_risk_short(tx(spark, sf))


CODES = f"""concat_ws(';', CASE WHEN amount > 5000 THEN 'HIGH_AMOUNT' END,
    CASE WHEN is_international AND amount > 1000 THEN 'HIGH_INTERNATIONAL_TX' END,
    CASE WHEN is_suspicious_hour THEN 'SUSPICIOUS_HOUR' END,
    CASE WHEN merchant_category IN {WIRE} THEN 'RISKY_MERCHANT' END)"""


@query("alert_reasons", f"SELECT transaction_id, {CODES} AS alert_reasons FROM scored")
def _(spark, sf):
    return scored(spark, sf).select("transaction_id", profiles.alert_reasons().alias("alert_reasons"))


@query("alert_events", f"""SELECT sha256(transaction_id || '|' || alert_type) AS alert_id, transaction_id, customer_id,
    alert_level, alert_type, alert_type || ' for ' || customer_id || ' amount ' || printf('%.2f', amount) AS description,
    fraud_score, amount, 'OPEN' AS status, timestamp_ms AS created_at, CAST({DATE} AS VARCHAR) AS alert_date
    FROM alerts""")
def _(spark, sf):
    return profiles.to_warehouse(profiles.alert_events(scored(spark, sf)), "fraud_alerts").drop("resolved_at",
                                                                                             "resolved_by")


@query("fraud_predictions", f"""SELECT sha256(transaction_id || '|rules-1') AS prediction_id, transaction_id,
    customer_id, fraud_score AS fraud_probability, is_fraud, risk_level, {CODES} AS alert_reasons,
    'rules-1' AS model_version, CAST({DATE} AS VARCHAR) AS prediction_date FROM scored""")
def _(spark, sf):
    return profiles.to_warehouse(profiles.predictions(scored(spark, sf)), "fraud_predictions").drop("processed_at")


@query("adjusted_score", f""", basics AS (SELECT customer_id, {MEAN} AS profile_avg_amount,
      MAX(amount) AS profile_max_amount, {FRAUDS} AS history_fraud_count FROM tx WHERE {HISTORY} GROUP BY customer_id
    ), joined AS (SELECT s.*, b.* EXCLUDE (customer_id),
      COALESCE((amount - profile_avg_amount) / NULLIF(profile_avg_amount, 0), 0) AS amount_deviation
      FROM scored s LEFT JOIN basics b USING (customer_id))
    SELECT transaction_id, amount_deviation, COALESCE(amount > profile_max_amount, FALSE) AS exceeds_historical_max,
      COALESCE(history_fraud_count > 0, FALSE) AS has_historical_fraud,
      CAST(score_points + CASE WHEN amount > profile_max_amount THEN 20 WHEN amount_deviation > 2 THEN 15
        WHEN history_fraud_count > 0 THEN 10 ELSE 0 END AS DOUBLE) / 100 AS adjusted_fraud_score FROM joined""")
def _(spark, sf):
    rows = scored(spark, sf)
    return profiles.adjust_score(rows, profiles.profile_basics(history_of(rows))).select(
        "transaction_id", "amount_deviation", "exceeds_historical_max", "has_historical_fraud",
        "adjusted_fraud_score")


OCTET = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CHECKS = [f"CASE WHEN {c} IS NULL THEN 'required:{c}' END" for c in (
    "transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_type", "channel", "location",
    "timestamp_ms", "card_type", "is_international", "merchant_category", "previous_balance")]
CHECKS += [f"CASE WHEN NOT regexp_full_match({c}, '{p}') THEN 'pattern:{c}' END" for c, p in (
    ("transaction_id", "TX[0-9]+-[0-9]+"), ("customer_id", "CUST[0-9]+"), ("merchant_id", "MERCH[0-9]+"),
    ("ip_address", rf"({OCTET}\.){{3}}{OCTET}"))]
CHECKS += [f"CASE WHEN {c} NOT IN {v} THEN 'enum:{c}' END" for c, v in (
    ("currency", ("EUR", "USD", "GBP", "CHF", "JPY")),
    ("transaction_type", ("PURCHASE", "WITHDRAWAL", "TRANSFER", "REFUND")),
    ("channel", ("ONLINE", "POS", "ATM", "MOBILE")), ("card_type", ("CREDIT", "DEBIT")))]
CHECKS += [f"CASE WHEN {c} < 0 THEN 'minimum:{c}' END" for c in ("amount", "previous_balance")]
BROKEN = f"concat_ws(';', {', '.join(CHECKS)})"


@query("validate_rows", f"SELECT transaction_id, {BROKEN} AS violations FROM tx")
def _(spark, sf):
    return quality.validate(tx_balance(spark, sf)).select("transaction_id", "violations")


@query("gen_transactions")
def _(spark, sf):
    """One synthetic transaction per event of the given table."""
    return generate.transactions(tables.table(spark, sf, "events").select("event_id"), "event_id")


STRICT = quality.RecordRules(required=("transaction_id", "device_id"), patterns={"customer_id": "^CUST[0-9]{1,2}$"},
                             allowed={"currency": ("EUR", "USD"), "card_type": ("CREDIT",)}, minimum={"amount": 5})


@query("violation_counts", """, broken AS (SELECT UNNEST([
      CASE WHEN device_id IS NULL THEN 'required:device_id' END,
      CASE WHEN length(customer_id) > 6 THEN 'pattern:customer_id' END,
      CASE WHEN currency IN ('GBP', 'CHF') THEN 'enum:currency' END,
      CASE WHEN card_type = 'DEBIT' THEN 'enum:card_type' END,
      CASE WHEN amount < 5 THEN 'minimum:amount' END]) AS violation FROM tx)
    SELECT violation, COUNT(*) AS row_count FROM broken WHERE violation IS NOT NULL GROUP BY violation""")
def _(spark, sf):
    """Validation with another rule set, so that there is something to find."""
    return quality.violation_counts(tx(spark, sf), STRICT)

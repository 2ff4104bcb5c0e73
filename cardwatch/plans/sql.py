"""SQL pieces for the comparison queries: the mapping of the given tables and exact aggregate expressions."""

from __future__ import annotations

C = "amount_cents"
N = "COUNT(*)"
TOTAL = f"CAST(SUM({C}) AS DOUBLE) / 100"
MEAN = f"CAST(SUM({C}) AS DOUBLE) / 100 / COUNT({C})"
MEAN_CENT = f"CAST((2 * SUM({C}) + COUNT({C})) // (2 * COUNT({C})) AS DOUBLE) / 100"
STDEV = (f"CASE WHEN COUNT({C}) >= 2 THEN SQRT(CAST(COUNT({C}) * SUM({C} * {C}) - SUM({C}) * SUM({C}) AS DOUBLE)"
         f" / (CAST(COUNT({C}) AS DOUBLE) * (COUNT({C}) - 1))) / 100 END")
STDEV_POP = STDEV.replace(f"(COUNT({C}) - 1)", f"COUNT({C})").replace(">= 2", ">= 1")
FRAUDS = "COUNT(*) FILTER (WHERE is_fraud)"
HITS = "COUNT(*) FILTER (WHERE is_fraud_predicted)"
SCORE = "CAST(SUM(score_points) AS DOUBLE) / 100 / COUNT(score_points)"
SCORE_4 = "CAST((2 * SUM(score_points) * 100 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 10000"


def pct(part: str, whole: str = N, digits: int = 2) -> str:
    return (f"CAST((2 * ({part}) * {10 ** (digits + 2)} + ({whole})) // (2 * ({whole})) AS DOUBLE)"
            f" / {10 ** digits}")


def total_if(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN {C} ELSE 0 END) AS DOUBLE) / 100"


def rate(part: str, whole: str = N) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF({whole}, 0)"


def level(points: str) -> str:
    return (f"CASE WHEN {points} >= 70 THEN 'CRITICAL' WHEN {points} >= 50 THEN 'HIGH'"
            f" WHEN {points} >= 30 THEN 'MEDIUM' ELSE 'LOW' END")


def flags(points: str) -> str:
    return (f"CAST({points} AS BIGINT) AS score_points, CAST({points} AS DOUBLE) / 100 AS fraud_score,"
            f" {level(points)} AS risk_level, {points} >= 50 AS is_fraud_predicted, {points} >= 50 AS alert_required")


def pick(values: tuple[str, ...], index: str) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


MS_TIME = "make_timestamp(timestamp_ms * 1000)"
DATE = f"CAST({MS_TIME} AS DATE)"
HOUR = "(timestamp_ms // 3600000) % 24"
HOUR_START = "timestamp_ms // 3600000 * 3600000"
W_CUSTOMER = "PARTITION BY customer_id ORDER BY timestamp_ms, transaction_id"
LAST_DAY = f"(SELECT MAX({DATE}) FROM tx)"
WIRE = "('GAMBLING', 'CRYPTO', 'WIRE_TRANSFER')"
RISKY = "('GAMBLING', 'CRYPTO')"
HISTORY = "timestamp_ms < 1705795200000"

PRELUDE = f"""
WITH base AS (
  SELECT e.event_id, e.event_type, e.user_id, e.value, epoch_us(e.ts) // 1000 AS timestamp_ms,
         CAST(ROUND(e.value * 100) AS BIGINT) AS v, GREATEST(c.c_acctbal, 0) AS previous_balance
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
), tx AS (
  SELECT 'TX' || timestamp_ms || '-' || event_id AS transaction_id, 'CUST' || user_id AS customer_id,
         'MERCH' || ((event_id * 31) % 97) AS merchant_id,
         CASE event_type WHEN 'purchase' THEN v * 40 WHEN 'error' THEN v // 20 ELSE v * 10 END AS amount_cents,
         CAST(amount_cents AS DOUBLE) / 100 AS amount,
         {pick(("EUR", "USD", "GBP", "CHF"), "event_id % 4")} AS currency,
         CASE event_type WHEN 'view' THEN 'WITHDRAWAL' WHEN 'signup' THEN 'TRANSFER' ELSE 'PURCHASE' END
           AS transaction_type,
         CASE event_type WHEN 'purchase' THEN 'ONLINE' WHEN 'click' THEN 'POS' WHEN 'view' THEN 'ATM'
           ELSE 'MOBILE' END AS channel,
         {pick(("Paris", "London", "New York", "Tokyo", "Singapore", "Dubai"), "(event_id * 7) % 6")} AS location,
         {pick(("FR", "GB", "US", "JP", "SG", "AE"), "(event_id * 7) % 6")} AS country,
         CASE WHEN event_id % 7 <> 0 THEN 'DEV' || ((event_id * 11) % 200) END AS device_id,
         CASE WHEN event_type <> 'view' THEN '10.0.' || ((event_id * 3) % 256) || '.' || (event_id % 256) END
           AS ip_address,
         timestamp_ms, CASE WHEN event_id % 3 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS card_type,
         (event_id * 17) % 10 = 3 AS is_international,
         {pick(("RETAIL", "GROCERY", "RESTAURANT", "ONLINE", "TRAVEL", "ENTERTAINMENT", "UTILITIES", "HEALTHCARE",
                "GAMBLING", "CRYPTO", "WIRE_TRANSFER"), "((event_id * 31) % 97) % 11")} AS merchant_category,
         CAST(previous_balance AS DOUBLE) AS previous_balance,
         CASE WHEN event_id % 101 <> 0 THEN (event_type = 'purchase' AND value > 125) OR event_id % 41 = 0 END
           AS is_fraud
  FROM base
), enriched AS (
  SELECT *, CAST({HOUR} AS BIGINT) AS hour, CAST(dayofweek({MS_TIME}) + 1 AS BIGINT) AS day_of_week,
         dayofweek({MS_TIME}) IN (0, 6) AS is_weekend, {HOUR} BETWEEN 0 AND 5 AS is_suspicious_hour
  FROM tx
), pointed AS (
  SELECT *, CASE WHEN amount > 10000 THEN 40 WHEN amount > 5000 THEN 30 ELSE 0 END
         + CASE WHEN is_international AND amount > 1000 THEN 20 ELSE 0 END
         + CASE WHEN is_suspicious_hour THEN 15 ELSE 0 END
         + CASE WHEN merchant_category IN {WIRE} THEN 25 ELSE 0 END
         + CASE WHEN is_weekend AND amount > 2000 THEN 10 ELSE 0 END AS pts
  FROM enriched
), scored AS (SELECT *, {flags("pts")} FROM pointed
), alerts AS (
  SELECT s.*, r.alert_type,
         CASE risk_level WHEN 'CRITICAL' THEN 'CRITICAL' ELSE 'WARNING' END AS alert_level
  FROM scored s, LATERAL (SELECT UNNEST([
         CASE WHEN amount > 5000 THEN 'HIGH_AMOUNT' END,
         CASE WHEN is_international AND amount > 1000 THEN 'HIGH_INTERNATIONAL_TX' END,
         CASE WHEN is_suspicious_hour THEN 'SUSPICIOUS_HOUR' END,
         CASE WHEN merchant_category IN {WIRE} THEN 'RISKY_MERCHANT' END]) AS alert_type) r
  WHERE s.alert_required AND r.alert_type IS NOT NULL
), seq AS (
  SELECT *, ROW_NUMBER() OVER w AS rn, LAG(location) OVER w AS p_location, LAG(timestamp_ms) OVER w AS p_ms,
         LAG(amount) OVER w AS p_amount, LAG({C}) OVER w AS p_cents, LAG(transaction_id) OVER w AS p_id
  FROM tx WINDOW w AS ({W_CUSTOMER})
), profile AS (
  SELECT customer_id, {MEAN} AS avg_transaction_amount, {STDEV} AS std_transaction_amount,
         MAX(amount) AS max_transaction_amount, {N} AS total_transactions,
         CAST({N} AS DOUBLE) / (date_diff('day', MIN({DATE}), MAX({DATE})) + 1) AS avg_transactions_per_day,
         {FRAUDS} AS fraud_count, {rate(FRAUDS)} AS fraud_rate, MAX(timestamp_ms) AS last_transaction_time
  FROM tx GROUP BY customer_id
)
"""

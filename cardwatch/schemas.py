"""Schemas of the transaction table, its variants and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I, _B, _TS, _DT = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(),
                                T.TimestampType(), T.DateType())
_A = T.ArrayType(T.StringType())


def _struct(fields: list[tuple[str, T.DataType]], optional: set[str] | None = None) -> T.StructType:
    return T.StructType([T.StructField(n, t, optional is None or n in optional) for n, t in fields])


# Input names of the 16-column transaction record and their canonical names.
FIELD_NAMES = {
    "transactionId": "transaction_id",
    "customerId": "customer_id",
    "merchantId": "merchant_id",
    "amount": "amount",
    "currency": "currency",
    "transactionType": "transaction_type",
    "channel": "channel",
    "location": "location",
    "deviceId": "device_id",
    "ipAddress": "ip_address",
    "timestamp": "timestamp_ms",
    "cardType": "card_type",
    "isInternational": "is_international",
    "merchantCategory": "merchant_category",
    "previousBalance": "previous_balance",
    "isFraud": "is_fraud",
}
# Names that occur only in variants of the record.
VARIANT_NAMES = {
    "country": "country",
    "timestampStr": "timestamp_text",
    "fraudType": "fraud_type",
    "fraudScore": "fraud_score",
    "riskLevel": "risk_level",
    "isFraudPredicted": "is_fraud_predicted",
    "alertRequired": "alert_required",
}

_TYPES = {"amount": _D, "timestamp_ms": _L, "is_international": _B, "previous_balance": _D, "is_fraud": _B}
_OPTIONAL = {"device_id", "ip_address", "is_fraud"}

TRANSACTION = _struct([(n, _TYPES.get(n, _S)) for n in FIELD_NAMES.values()], _OPTIONAL)
"""Canonical 16 columns, snake_case."""

TRANSACTION_INPUT = T.StructType([T.StructField(a, _TYPES.get(b, _S), True) for a, b in FIELD_NAMES.items()])
"""The same record under its input names; every field nullable, as files may miss any."""

STREAM_MESSAGE = T.StructType([f for f in TRANSACTION_INPUT if f.name != "isFraud"])
"""JSON payload of the message stream: no label."""

CLOUD_MESSAGE = T.StructType(
    [f for f in TRANSACTION_INPUT if f.name not in {"transactionType", "deviceId", "ipAddress"}]
    + [T.StructField("country", _S), T.StructField("timestampStr", _S), T.StructField("fraudType", _S)])

NOTEBOOK_RECORD = T.StructType(
    [f for f in TRANSACTION_INPUT if f.name not in {"transactionType", "deviceId", "ipAddress"}])

WAREHOUSE = {
    "transactions": _struct([(n, _TYPES.get(n, _S)) for n in list(FIELD_NAMES.values())[:-1]]
                            + [("fraud_score", _D), ("is_fraud_predicted", _B), ("risk_level", _S),
                               ("transaction_date", _DT)]),
    "fraud_predictions": _struct([("prediction_id", _S), ("transaction_id", _S), ("customer_id", _S),
                                  ("fraud_probability", _D), ("is_fraud", _B), ("risk_level", _S),
                                  ("alert_reasons", _A), ("model_version", _S), ("processed_at", _TS),
                                  ("prediction_date", _DT)]),
    "customer_profiles": _struct([("customer_id", _S), ("avg_transaction_amount", _D), ("std_transaction_amount", _D),
                                  ("max_transaction_amount", _D), ("total_transactions", _L),
                                  ("avg_transactions_per_day", _D), ("fraud_count", _I), ("fraud_rate", _D),
                                  ("preferred_locations", _A), ("preferred_merchants", _A),
                                  ("last_transaction_time", _TS), ("profile_updated_at", _TS)]),
    "merchant_risk_scores": _struct([("merchant_id", _S), ("merchant_category", _S), ("total_transactions", _L),
                                     ("total_volume", _D), ("fraud_count", _I), ("fraud_volume", _D),
                                     ("fraud_rate", _D), ("risk_score", _D), ("risk_category", _S),
                                     ("last_updated", _TS)]),
    "fraud_alerts": _struct([("alert_id", _S), ("transaction_id", _S), ("customer_id", _S), ("alert_level", _S),
                             ("alert_type", _S), ("description", _S), ("fraud_score", _D), ("amount", _D),
                             ("status", _S), ("created_at", _TS), ("resolved_at", _TS), ("resolved_by", _S),
                             ("alert_date", _DT)]),
    "hourly_metrics": _struct([("metric_hour", _TS), ("total_transactions", _L), ("total_volume", _D),
                               ("avg_amount", _D), ("fraud_count", _I), ("fraud_volume", _D), ("fraud_rate", _D),
                               ("critical_alerts", _I), ("high_alerts", _I), ("avg_latency_ms", _D),
                               ("unique_customers", _I), ("unique_merchants", _I)]),
}
# Partition columns of the warehouse tables.
PARTITIONS = {
    "transactions": ["risk_level", "transaction_date"],
    "fraud_predictions": ["prediction_date"],
    "fraud_alerts": ["alert_date"],
}

"""Boundaries of bands, rules, levels and labels."""

import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from cardwatch.functions import rules, times
from cardwatch.operators import dashboards, profiles, shape, windows

EDGES = [4.99, 5.0, 99.99, 100.0, 999.99, 1000.0, 1000.01, 4999.99, 5000.0, 5000.01, 10000.0, 10000.01]


def ms(text):
    return int(dt.datetime.fromisoformat(text + "+00:00").timestamp() * 1000)


MIDDAY = ms("2024-01-03T12:00:00")  # a Wednesday


def test_amount_edges(make):
    df = make(*[{"amount": a, "timestamp_ms": MIDDAY, "transaction_id": f"TX{i:02d}-1"} for i, a in enumerate(EDGES)])
    out = values(shape.derive(df), "amount_category", "risk_score", "is_high_amount")
    assert [b for b, _, _ in out] == ["LOW"] * 3 + ["MEDIUM"] * 2 + ["HIGH"] * 3 + ["VERY_HIGH"] * 4
    assert [s for _, s, _ in out] == [0.1] * 9 + [0.5, 0.5, 0.8]
    assert [h for _, _, h in out] == [False] * 9 + [True] * 3
    scored = rules.apply(shape.enrich(df), rules.stream_rules())
    assert values(scored, "score_points") == [0] * 9 + [30, 30, 40]


def test_levels_at_exact_sums(make):
    base = {"timestamp_ms": MIDDAY}
    df = make({**base, "amount": 5000.01},  # 30
              {**base, "amount": 5000.01, "is_international": True},  # 50
              {**base, "amount": 5000.01, "merchant_category": "CRYPTO", "timestamp_ms": ms("2024-01-03T05:00:00")},  # 70
              {**base, "amount": 100.0, "merchant_category": "WIRE_TRANSFER"})  # 25
    scored = rules.apply(shape.enrich(df), rules.stream_rules())
    assert values(scored, "fraud_score", "risk_level", "is_fraud_predicted") == [
        (0.3, "MEDIUM", False), (0.5, "HIGH", True), (0.7, "CRITICAL", True), (0.25, "LOW", False)]


def test_night_and_weekend(make):
    moments = ["2024-01-05T23:59:59.999", "2024-01-06T00:00:00", "2024-01-06T05:59:59.999", "2024-01-06T06:00:00",
               "2024-01-07T12:00:00", "2024-01-08T00:00:00"]
    df = shape.enrich(make(*[{"timestamp_ms": ms(m)} for m in moments]))
    assert values(df, "is_suspicious_hour") == [False, True, True, False, False, True]
    assert values(df, "is_weekend") == [False, True, True, True, True, False]
    assert values(df, "day_of_week") == [6, 7, 7, 7, 1, 2]


def test_balance_ratio(make):
    df = shape.enrich_balance(make({"amount": 80.0, "previous_balance": 100.0}, {"amount": 5.0, "previous_balance": 0.0},
                                   {"amount": 81.0, "previous_balance": 100.0}))
    assert values(df, "amount_to_balance_ratio") == [0.8, 1.0, 0.81]
    assert values(rules.apply(df, rules.CLOUD), "score_points") == [15, 35, 35]  # hour 0 adds 15


def test_reasons_are_never_null(make):
    df = shape.enrich(make({"amount": 6000.0, "is_international": True, "merchant_category": "GAMBLING"},
                           {"timestamp_ms": MIDDAY}, {"merchant_category": None, "timestamp_ms": MIDDAY}))
    out = values(df.withColumn("r", profiles.alert_reasons()), "r")
    assert out == [["HIGH_AMOUNT", "HIGH_INTERNATIONAL_TX", "SUSPICIOUS_HOUR", "RISKY_MERCHANT"], [], []]
    assert profiles.suspicious(df).count() == 1


def test_reason_texts(make):
    df = make({"amount": 6000.5, "timestamp_ms": ms("2024-01-01T03:10:00")})
    assert values(profiles.suspicious(df), "reasons") == [["HIGH_AMOUNT: 6000.5", "SUSPICIOUS_HOUR: 3"]]
    assert values(profiles.suspicious_short(df), "reasons") == [["HIGH_AMOUNT: 6000.50€"]]


def test_level_rank_and_day_part(spark):
    df = spark.createDataFrame([("LOW",), ("CRITICAL",), ("HIGH",), ("MEDIUM",), ("other",)], "l string")
    assert [r[0] for r in df.select(rules.level_rank(F.col("l"))).collect()] == [4, 1, 2, 3, 4]
    hours = spark.createDataFrame([(h,) for h in (0, 5, 6, 11, 12, 17, 18, 23)], "h int")
    assert [r[0] for r in hours.select(times.day_part(F.col("h"))).collect()] == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]


@pytest.mark.parametrize("gap,expected", [(1_799_999, True), (1_800_000, False)])
def test_travel_gap(make, gap, expected):
    df = windows.fraud_patterns(make({"timestamp_ms": 0}, {"timestamp_ms": gap, "location": "Tokyo"}))
    assert values(df, "impossible_travel") == [False, expected]


def test_same_city_is_no_travel_and_small_amounts_count(make):
    df = windows.fraud_patterns(make(*[{"timestamp_ms": i, "amount": a} for i, a in enumerate([1.0, 4.99, 5.0, 2.0, 9.0])]))
    assert values(df, "impossible_travel") == [False] * 5
    assert values(df, "card_testing") == [False, False, False, True, True]


def test_history_needs_two_earlier_rows_and_spread(make):
    df = windows.history(make(*[{"timestamp_ms": i, "amount": a} for i, a in enumerate([10.0, 10.0, 10.0, 20.0])]))
    assert values(df, "historical_std") == [None, None, 0.0, 0.0]
    assert values(df, "amount_zscore") == [0.0] * 4


def test_statistics_of_single_and_equal_rows(make):
    df = make({"customer_id": "CUST1"}, {"customer_id": "CUST2"}, {"customer_id": "CUST2"})
    from cardwatch.operators import aggregates
    assert values(aggregates.by_customer(df), "stddev_amount", order="customer_id") == [None, 0.0]
    assert values(profiles.zscore_population(df), "amount_zscore") == [0.0] * 3
    assert profiles.abnormal_customers(df).isEmpty()


def test_null_labels_are_in_no_confusion_cell(make):
    df = make({"is_fraud": None, "amount": 20000.0}, {"is_fraud": True, "amount": 20000.0, "is_international": True},
              {"is_fraud": False})
    row = dashboards.confusion(rules.apply(shape.enrich(df), rules.stream_rules())).first()
    assert (row.true_positives, row.false_positives, row.false_negatives, row.true_negatives) == (1, 0, 0, 1)
    assert row.precision == row.recall == row.f1 == 1.0


def test_adjusted_score_order(make):
    rows = make({"amount": 500.0, "timestamp_ms": MIDDAY}, {"amount": 90.0, "timestamp_ms": MIDDAY},
                {"amount": 20.0, "timestamp_ms": MIDDAY}, {"customer_id": "CUST9", "timestamp_ms": MIDDAY})
    scored = rules.apply(shape.enrich(rows), rules.stream_rules())
    basics = rows.sparkSession.createDataFrame(
        [("CUST1", 25.0, 100.0, 2)], "customer_id string, profile_avg_amount double, profile_max_amount double, "
                                     "history_fraud_count bigint")
    assert values(profiles.adjust_score(scored, basics), "adjusted_fraud_score") == [0.2, 0.15, 0.1, 0.0]

"""Cube labels, counts that must add up, deciles, dates relative to now, generator, quality."""

import pytest
from conftest import MEDIUM, values
from pyspark.sql import functions as F

from cardwatch.functions import rules
from cardwatch.operators import aggregates, dashboards, generate, profiles, quality, shape


@pytest.fixture(scope="module")
def generated(spark):
    return generate.transactions(spark.range(20_000), customers=500, merchants=50, fraud_rate=0.05)


def test_null_key_is_not_a_cube_total(make):
    df = make({"merchant_category": None}, {"merchant_category": "RETAIL"})
    out = aggregates.cube_by_channel(df).where("channel = 'ALL' AND card_type = 'ALL'")
    assert {(r["merchant_category"], r["transaction_count"]) for r in out.collect()} == {
        ("ALL", 2), ("RETAIL", 1), (None, 1)}


def test_cube_levels_add_up(generated):
    cube = aggregates.cube_by_channel(generated).cache()
    n = generated.count()
    for keys in (("merchant_category",), ("channel", "card_type"), ("merchant_category", "channel", "card_type")):
        rest = {"merchant_category", "channel", "card_type"} - set(keys)
        level = cube.where(" AND ".join([f"{k} <> 'ALL'" for k in keys] + [f"{k} = 'ALL'" for k in rest]))
        assert level.agg(F.sum("transaction_count")).first()[0] == n
    cube.unpersist()


@pytest.mark.parametrize("slot", [60_000, 86_400_000])
def test_deciles_are_even(generated, slot):
    scored = rules.apply(shape.enrich(generated.limit(9_997)), rules.stream_rules())
    sizes = [r["transaction_count"] for r in dashboards.score_deciles(scored, slot_ms=slot).collect()]
    assert len(sizes) == 10 and sum(sizes) == 9_997 and sizes == [1000] * 7 + [999] * 3


def test_confusion_cells_add_up(generated):
    scored = rules.apply(shape.enrich(generated), rules.stream_rules())
    row = dashboards.confusion(scored).first()
    assert row.true_positives + row.false_positives + row.false_negatives + row.true_negatives == generated.count()


def test_as_of_can_be_given(make):
    day = 86_400_000
    scored = rules.apply(shape.enrich(make(*[{"timestamp_ms": d * day} for d in range(20)])), rules.stream_rules())
    assert dashboards.daily_summary(scored).count() == 8
    assert dashboards.daily_summary(scored, as_of=F.lit("1970-01-25").cast("date")).count() == 3
    assert dashboards.daily_summary(scored, as_of=F.lit("1970-01-10").cast("date")).count() == 8
    assert dashboards.end_of_day(scored, as_of=F.lit("1970-01-10").cast("date")).first().total_transactions == 1
    assert dashboards.minute_metrics(scored, as_of_ms=F.lit(0)).count() == 1


def test_exact_percentiles_against_sorting(make):
    df = make(*[{"amount": float(a)} for a in range(1, 101)])
    row = aggregates.percentiles_exact(df).first()
    assert (row.q1, row["median"], row.q3, row.p90, row.p95, row.p99, row.max_amount) == (25, 50, 75, 90, 95, 99, 100)


def test_generator_is_repeatable_and_balanced(spark, generated):
    again = generate.transactions(spark.range(20_000).repartition(13), customers=500, merchants=50, fraud_rate=0.05)
    assert generated.exceptAll(again).isEmpty()
    shares = generated.groupBy("is_fraud").count().collect()
    fraud = {r["is_fraud"]: r["count"] for r in shares}[True]
    assert 850 < fraud < 1150
    by_type = {r["fraud_type"]: r for r in generated.where("is_fraud").groupBy("fraud_type").agg(
        F.min("amount").alias("lo"), F.max("amount").alias("hi"), F.count("*").alias("n")).collect()}
    assert set(by_type) == {p[0] for p in generate.CLOUD_PATTERNS}
    for name, low, high in generate.CLOUD_PATTERNS:
        assert low <= by_type[name]["lo"] and by_type[name]["hi"] <= high and by_type[name]["n"] > 120
    assert generated.where("NOT is_fraud").agg(F.min("amount")).first()[0] >= 1
    assert quality.validate(generated.drop("ip_address").withColumn("ip_address", F.lit(None).cast("string"))).where(
        F.size("violations") > 0).isEmpty()


def test_card_family_of_patterns(spark):
    df = generate.transactions(spark.range(5000), fraud_rate=1.0, cloud=False)
    night = df.where("fraud_type = 'night'")
    assert night.where("timestamp_ms div 3600000 % 24 > 4 OR channel <> 'ATM'").isEmpty() and night.count() > 800
    assert df.where("fraud_type = 'suspicious_international' AND NOT is_international").isEmpty()


def test_home_country_decides_international(generated):
    usual = generated.where("NOT is_fraud").groupBy("customer_id", "country").agg(
        F.count_distinct("is_international").alias("kinds"))
    assert usual.where("kinds > 1").isEmpty()


def test_violations(make):
    df = quality.validate(make({"transaction_id": "X1"}, {"currency": "SGD", "amount": -1.0}, {"ip_address": "10.0.0.256"},
                               {"ip_address": "10.0.0.25", "channel": None}))
    assert values(df.orderBy("currency"), "violations") == [
        ["enum:currency", "minimum:amount"], ["pattern:ip_address"], ["required:channel"], ["pattern:transaction_id"]]


def test_quality_counts_repeats_and_limits(make):
    df = make({"transaction_id": "TX1-1"}, {"transaction_id": "TX1-1"}, {"channel": None})
    row = quality.quality(df).first()
    assert (row.total_rows, row.null_rate, row.duplicate_rate, row.schema_valid, row.passed) == (
        3, 1 / 3, 1 / 3, True, False)
    assert not quality.quality(df.drop("currency")).first().schema_valid
    assert quality.quality(df.limit(1), exact=False).first().passed


def test_preferred_values_are_ordered(make):
    rows = [{"location": p} for p in ("Paris", "Tokyo", "Tokyo", "Dubai", "Dubai", "London", "Dubai")]
    assert profiles.customer_profiles(make(*rows)).first()["preferred_locations"] == ["Dubai", "Tokyo", "London"]


def test_profile_has_warehouse_shape(spark):
    from cardwatch.schemas import WAREHOUSE
    from cardwatch.sources.tables import transactions
    df = profiles.to_warehouse(profiles.customer_profiles(transactions(spark, MEDIUM)), "customer_profiles")
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in WAREHOUSE["customer_profiles"]]
    assert df.count() == 150


def test_co_moments_of_very_many_rows(spark):
    from decimal import Decimal
    from fractions import Fraction
    from cardwatch.functions import numbers
    cells = [(10**9 - 7, 1, 4 * 10**12 + 1), (10**9, 0, 5 * 10**12 + 3), (10**9 + 11, 1, 10**12 + 9), (3, 0, 17)]  # x, y, rows
    few = [(x, y, w % 1000) for x, y, w in cells]
    for rows in (cells, few, [(5, 1, 1)]):
        n, sx, sy = (sum(w for *_, w in rows), sum(x * w for x, _, w in rows), sum(y * w for _, y, w in rows))
        sxx, sxy = sum(x * x * w for x, _, w in rows), sum(x * y * w for x, y, w in rows)
        one = spark.createDataFrame([tuple(map(Decimal, (n, sx, sy, sxx, sxy)))],
                                    ", ".join(f"{c} decimal(38,0)" for c in ("n", "sx", "sy", "sxx", "sxy")))
        got = one.select(numbers.co_moment(F.col("n"), F.col("sx"), F.col("sx"), F.col("sxx")),
                         numbers.co_moment(F.col("n"), F.col("sx"), F.col("sy"), F.col("sxy"))).first()
        for found, want in zip(got, (n * sxx - sx * sx, n * sxy - sx * sy)):
            assert abs(Fraction(found) - want) <= abs(want) * Fraction(1, 10**12)


def test_deviations_of_very_many_rows_do_not_pass_38_digits(spark):
    from cardwatch.functions import numbers
    n, half = 10 ** 13, 5 * 10 ** 12
    low, high = 10 ** 9, 3 * 10 ** 9
    one = spark.sql(
        f"select {n}L as n, cast('{half * (low + high)}' as decimal(38,0)) as s1, "
        f"cast('{half * (low * low + high * high)}' as decimal(38,0)) as s2, cast(null as decimal(38,0)) as none")
    got = one.select(numbers.deviation(F.col("n"), F.col("s1"), F.col("s2"), sample=False),
                     numbers.deviation(F.col("n"), F.col("none"), F.col("none"))).first()
    assert got[0] == pytest.approx(10 ** 7, rel=1e-12) and got[1] is None

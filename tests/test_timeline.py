"""Sliced timelines give what plain windows give, whatever the slice size."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardwatch.operators import aggregates, busy, timeline, windows
from cardwatch.operators.spread import join_per_key
from cardwatch.operators.timeline import Timeline

JOBS = {
    "rolling": windows.rolling, "velocity": windows.velocity, "history": windows.history,
    "patterns": windows.fraud_patterns, "trace": windows.velocity_trace, "ties": windows.running_with_ties,
    "sequence": windows.sequence, "pairs": windows.pattern_pairs, "features": windows.features,
}


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("job", JOBS)
def test_sliced_customers_equal_unsliced(medium_tx, job):
    same(JOBS[job](medium_tx, line=Timeline()), JOBS[job](medium_tx, line=Timeline(rows_per_slice=25)))


@pytest.mark.parametrize("rows", [40, 400])
def test_one_key_with_a_third_of_all_rows(medium_tx, rows):
    """A third of the rows moves to one customer; sliced results equal a plain window over it."""
    hot = medium_tx.withColumn("customer_id", F.when(F.pmod(F.hash("transaction_id"), F.lit(3)) == 0, "CUST1")
                               .otherwise(F.col("customer_id")))
    plain = Window.partitionBy("customer_id").orderBy("timestamp_ms", "transaction_id")
    expected = hot.select(
        "transaction_id", F.lag("timestamp_ms").over(plain).alias("prev_timestamp_ms"),
        F.lag("location").over(plain).alias("prev_location"),
        F.count("*").over(Window.partitionBy("customer_id").orderBy("timestamp_ms").rangeBetween(-3_600_000, 0))
        .alias("tx_count_last_hour"), F.row_number().over(plain).cast("bigint").alias("tx_sequence"))
    actual = windows.velocity_trace(hot, Timeline(rows_per_slice=rows)).select(*expected.columns)
    same(actual, expected)


def test_slices_are_small_and_many(medium_tx):
    line = Timeline(key="currency", rows_per_slice=200)
    cut = line.cut(medium_tx)
    sizes = [r["count"] for r in cut.groupBy("currency", "_slice").count().collect()]
    assert sum(sizes) == medium_tx.count() and max(sizes) <= 200 and len(sizes) > 4 * 12


def test_rows_of_equal_time(make):
    rows = [{"timestamp_ms": 1000 * (i // 4), "amount": float(i)} for i in range(40)]
    df = make(*rows)
    for job in ("ties", "rolling", "velocity", "trace"):
        same(JOBS[job](df, line=Timeline()), JOBS[job](df, line=Timeline(rows_per_slice=3)))


def test_grouped_rows_are_bounded_and_complete(medium_tx):
    grouped = aggregates.grouped_rows(medium_tx, 7, Timeline(rows_per_slice=30))
    sizes = grouped.select("customer_id", "part", F.size("rows").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 7
    assert sizes.agg(F.sum("n")).first()[0] == medium_tx.count()
    assert grouped.select(F.explode("rows").alias("r")).select("r.transaction_id").distinct().count() == 10_000


def odd_shapes(make):
    """A missing customer, a burst at one instant, a stray row years before, and ordinary customers."""
    rows = [{"customer_id": None, "timestamp_ms": 5_000_000_000 + 700_000 * (i // 3), "amount": float(i % 9)} for i in range(60)]
    rows += [{"customer_id": "BURST", "timestamp_ms": 5_000_000_000, "amount": float(i % 7)} for i in range(50)]
    rows += [{"customer_id": "BURST", "timestamp_ms": 5_000_000_000 + 1_800_000 * (i % 4), "amount": 2.5} for i in range(20)]
    rows += [{"customer_id": "STRAY", "timestamp_ms": 1000 if i == 0 else 6_000_000_000 + 60_000 * i, "amount": 1.0 + i}
             for i in range(70)]
    rows += [{"customer_id": f"C{i % 5}", "timestamp_ms": 5_500_000_000 + 10_000 * i, "amount": 4.0} for i in range(30)]
    return make(*[{"location": ("Paris", "Tokyo", None)[i % 3], **r} for i, r in enumerate(rows)])


@pytest.mark.parametrize("limit", [1, 16])
def test_no_slice_is_larger_than_the_limit(make, limit):
    cut = Timeline(rows_per_slice=limit).cut(odd_shapes(make))
    sizes = [r["count"] for r in cut.where("_is_busy").groupBy("customer_id", "_slice").count().collect()]
    assert max(sizes) <= limit and sum(sizes) + cut.where("not _is_busy").count() == 230
    assert cut.where("_is_busy").select("customer_id").distinct().count() >= 3


@pytest.mark.parametrize("job", JOBS)
@pytest.mark.parametrize("limit,stretch", [(7, 1000)])
def test_odd_shapes_equal_plain_windows(make, monkeypatch, job, limit, stretch):
    df = odd_shapes(make).cache()
    monkeypatch.setattr(timeline, "STRETCH", stretch)
    same(JOBS[job](df, line=Timeline(rows_per_slice=limit)), JOBS[job](df, line=Timeline()))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("few", [0, 100_000])
def test_joins_spread_busy_and_missing_keys(spark, make, monkeypatch, how, few):
    monkeypatch.setattr(busy, "FEW_KEYS", few)
    df = odd_shapes(make)
    per_key = df.groupBy("customer_id").agg(F.count("*").alias("n")).where("customer_id is null or customer_id <> 'C1'")
    same(join_per_key(df, per_key, how=how, rows_per_copy=9), df.join(per_key, "customer_id", how))
    known = df.groupBy("customer_id").agg(F.count("*").alias("_rows"))
    same(join_per_key(df, per_key, ["customer_id"], how, rows_per_copy=9, sizes=known), df.join(per_key, "customer_id", how))


def test_positions_are_exact(make):
    found = busy.positions(odd_shapes(make).repartition(5), "customer_id", ["timestamp_ms", "transaction_id"], "at")
    rows = found.select("customer_id", "at", F.struct("timestamp_ms", "transaction_id").alias("o")).collect()
    for key in {r.customer_id for r in rows}:
        own = sorted((r.at, r.o) for r in rows if r.customer_id == key)
        assert [a for a, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)

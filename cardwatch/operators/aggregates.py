"""Grouped aggregates. Each is one pass with partial aggregation before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions import numbers, times
from cardwatch.functions.numbers import CENTS, count_if, mean, percent, ratio, total, total_if, whole_div
from cardwatch.operators.shape import join_null_safe
from cardwatch.operators.timeline import Timeline


def rows() -> Column:
    return F.count("*")


def labelled(label: str = "is_fraud") -> Column:
    return count_if(F.col(label))


def total_by_customer(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(total().alias("total_amount"))


def grouped_rows(df: DataFrame, rows_per_group: int = 1000, line: Timeline = Timeline()) -> DataFrame:
    """All rows of each customer, as arrays of at most ``rows_per_group`` rows in time order.

    A customer with more rows gets several numbered parts, so no array and no
    task holds an unbounded group.
    """
    numbered = line.close(line.running(line.cut(df), {"_row": F.lit(1)}))
    fields = [line.time, *line.ties, *[c for c in df.columns if c not in (line.key, line.time, *line.ties)]]
    part = whole_div(F.col("_row") - 1, F.lit(rows_per_group))
    return (numbered.groupBy(line.key, part.alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows")))


def merchant_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_id").agg(total().alias("total_amount"), F.max("amount").alias("max_amount"),
                                         rows().alias("transaction_count"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(rows().alias("transaction_count"))


def by_customer(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(
        rows().alias("transaction_count"), total().alias("total_amount"), mean().alias("avg_amount"),
        F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"),
        numbers.stdev().alias("stddev_amount"), labelled().alias("fraud_count"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
        F.count_distinct("location").alias("unique_locations"))


def by_merchant(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_id", "merchant_category").agg(
        rows().alias("transaction_count"), total().alias("total_revenue"), mean().alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
        ratio(labelled(), rows()).alias("fraud_rate")).orderBy(F.desc("fraud_rate"), "merchant_id")


def active_customers(df: DataFrame, min_rows: int = 5) -> DataFrame:
    return (df.groupBy("customer_id").agg(
        rows().alias("total_transactions"), total().alias("total_amount"), mean().alias("avg_amount"),
        F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"),
        numbers.stdev().alias("stddev_amount"), labelled().alias("fraud_count"),
        (labelled() * 100 / rows()).alias("fraud_rate"))
        .where(F.col("total_transactions") >= min_rows).orderBy(F.desc("fraud_rate"), "customer_id"))


def by_category(df: DataFrame) -> DataFrame:
    return df.groupBy("merchant_category").agg(
        rows().alias("transaction_count"), total().alias("total_volume"), mean().alias("avg_transaction"),
        F.count_distinct("customer_id").alias("unique_customers"), labelled().alias("fraud_count"),
        percent(labelled(), rows()).alias("fraud_rate_percent")
    ).orderBy(F.desc("fraud_rate_percent"), "merchant_category")


def by_category_scored(scored: DataFrame) -> DataFrame:
    """Category figures rounded to the cent, with the mean score."""
    return scored.groupBy("merchant_category").agg(
        rows().alias("tx_count"), total().alias("volume"), numbers.mean_rounded().alias("avg_amount"),
        labelled().alias("fraud_count"), percent(labelled(), rows()).alias("fraud_rate_pct"),
        mean_score().alias("avg_score"))


def mean_score(points: str = "score_points") -> Column:
    return F.sum(points) / F.lit(100) / F.count(points)


def mean_score_4(points: str = "score_points") -> Column:
    """Mean score rounded half up to four digits."""
    return numbers.rounded(F.sum(points) * 100, F.count(points)) / F.lit(10000)


def by_hour_of_day(df: DataFrame) -> DataFrame:
    return df.groupBy(times.hour_of_day().alias("hour_of_day")).agg(
        rows().alias("transaction_count"), total().alias("total_amount"), mean().alias("avg_amount"),
        labelled().alias("fraud_count"), percent(labelled(), rows()).alias("fraud_rate")).orderBy("hour_of_day")


def by_day_part(df: DataFrame) -> DataFrame:
    """Hour-of-day figures with the name of the part of the day."""
    hourly = by_hour_of_day(df).withColumnRenamed("hour_of_day", "hour")
    return hourly.select("hour", F.col("transaction_count").alias("tx_count"), F.col("total_amount").alias("volume"),
                         F.col("fraud_count").alias("frauds"), F.col("fraud_rate").alias("fraud_rate_pct"),
                         times.day_part(F.col("hour")).alias("time_period"))


def predicted_by_hour(scored: DataFrame) -> DataFrame:
    hit = F.col("is_fraud_predicted")
    return scored.groupBy(times.hour_of_day().alias("hour_of_day")).agg(
        rows().alias("total_transactions"), count_if(hit).alias("fraud_count"),
        (count_if(hit) * 100 / rows()).alias("fraud_rate_percent"), total().alias("total_volume"),
        total_if(hit).alias("fraud_volume")).orderBy("hour_of_day")


def trend(df: DataFrame) -> DataFrame:
    """Per date and hour."""
    return df.groupBy(times.event_date().alias("date"), times.hour_of_day().alias("hour")).agg(
        rows().alias("transaction_count"), total().alias("total_amount"), labelled().alias("fraud_count"),
        (labelled() * 100 / rows()).alias("fraud_rate")).orderBy("date", "hour")


def global_stats(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("total_transactions"), total().alias("total_amount"), mean().alias("avg_amount"),
                  F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"),
                  labelled().alias("fraud_count"), ratio(labelled(), rows()).alias("fraud_rate"))


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    return total_by_customer(df).orderBy(F.desc("total_amount"), "customer_id").limit(n)


def busiest_slot(df: DataFrame, slot_ms: int = times.HOUR_MS) -> DataFrame:
    """Largest number of rows of a customer in one fixed slot, in two aggregation steps."""
    per_slot = df.groupBy("customer_id", times.slot_start(slot_ms).alias("_slot")).agg(rows().alias("_n"))
    return per_slot.groupBy("customer_id").agg(F.max("_n").alias("max_tx_in_slot"))


def hourly_velocity(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id", F.date_trunc("hour", times.event_time()).alias("hour")).agg(
        rows().alias("tx_count"), total().alias("total_amount"),
        F.count_distinct("location").alias("unique_locations"))


def cube(df: DataFrame, keys: Sequence[str], measures: dict[str, Column], flags: bool = False) -> DataFrame:
    """CUBE with 'ALL' for the totals. The label goes by ``grouping()``, so a null key is not taken for a total."""
    levels = [F.grouping(k).alias(f"_all_{k}") for k in keys]
    cubed = df.cube(*keys).agg(*[m.alias(n) for n, m in measures.items()], *levels)
    labels = [F.when(F.col(f"_all_{k}") == 1, "ALL").otherwise(F.col(k)).alias(k) for k in keys]
    extra = [F.col(f"_all_{k}").cast("int").alias(f"all_{k}") for k in keys] if flags else []
    return cubed.select(*labels, *measures, *extra)


def cube_by_channel(df: DataFrame) -> DataFrame:
    return cube(df, ("merchant_category", "channel", "card_type"), {
        "transaction_count": rows(), "total_amount": total(), "avg_amount": mean(), "fraud_count": labelled()})


def cube_by_risk(scored: DataFrame) -> DataFrame:
    """Detail levels first, largest groups first within a level."""
    keys = ("merchant_category", "channel", "risk_level")
    out = cube(scored, keys, {"transaction_count": rows(), "total_volume": total(),
                              "avg_fraud_score": mean_score()}, flags=True)
    return out.orderBy(*[f"all_{k}" for k in keys], F.desc("transaction_count"), *keys)


QUANTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def percentiles(df: DataFrame, by: str = "merchant_category", accuracy: int = 10_000) -> DataFrame:
    """Approximate percentiles; the sketch is merged from partial aggregates and has a fixed size."""
    sketch = df.groupBy(by).agg(
        F.percentile_approx("amount", list(QUANTILES.values()), accuracy).alias("_q"),
        F.max("amount").alias("max_amount"))
    return sketch.select(by, *[F.col("_q")[i].alias(name) for i, name in enumerate(QUANTILES)], "max_amount")


def percentiles_exact(df: DataFrame, by: str | Sequence[str] = "merchant_category",
                      hundredths: dict[str, int] | None = None, block_cents: int = 10_000) -> DataFrame:
    """Exact percentiles: the smallest amount that at least the given share of the rows does not exceed.

    Works on counts per amount, ranked first in blocks of amounts and then within
    the block, so the rows of a large category never meet in one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    wanted = hundredths or {name: round(q * 100) for name, q in QUANTILES.items()}
    counts = df.groupBy(*by, CENTS).agg(rows().alias("_n")).withColumn(
        "_block", whole_div(F.col(CENTS), F.lit(block_cents)))
    lower = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(*by, "_block").agg(F.sum("_n").alias("_rows")).select(
        *by, "_block", F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_below"),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("_all"))
    inside = Window.partitionBy(*by, "_block").orderBy(CENTS).rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_null_safe(counts.withColumn("_upto", F.sum("_n").over(inside)), blocks, [*by, "_block"])
    ranked = ranked.withColumn("_upto", F.col("_upto") + F.col("_below"))
    at = {name: whole_div(F.col("_all") * q + 99, F.lit(100)) for name, q in wanted.items()}
    return ranked.groupBy(*by).agg(
        *[numbers.money(F.min(F.when(F.col("_upto") >= position, F.col(CENTS)))).alias(name)
          for name, position in at.items()], numbers.money(F.max(CENTS)).alias("max_amount"))


def segments(scored: DataFrame) -> DataFrame:
    """Figures per segment with exact median and 95th percentile."""
    hit, keys = F.col("is_fraud_predicted"), ["merchant_category", "channel", "risk_level"]
    out = scored.groupBy(*keys).agg(
        rows().alias("transaction_count"), total().alias("total_volume"), mean().alias("avg_amount"),
        count_if(hit).alias("fraud_count"), mean_score().alias("avg_fraud_score"))
    exact = percentiles_exact(scored, keys, {"median_amount": 50, "p95_amount": 95}).drop("max_amount")
    return join_null_safe(out, exact, keys).orderBy(*keys)


def geography(scored: DataFrame) -> DataFrame:
    return scored.groupBy("location", "country").agg(
        rows().alias("tx_count"), total().alias("volume"),
        count_if(F.col("is_international")).alias("international_tx"), labelled().alias("frauds"),
        percent(labelled(), rows()).alias("fraud_rate_pct"), mean_score().alias("avg_fraud_score"))


def bin_of(column: str, low: float, high: float, bins: int) -> Column:
    """Equal-width bin of a value; 0 is below, ``bins + 1`` at or above the range."""
    return F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    return df.groupBy(bin_of(column, low, high, bins).cast("bigint").alias("bin")).agg(rows().alias("row_count"))

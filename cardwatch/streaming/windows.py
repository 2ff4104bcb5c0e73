"""Time-window aggregates that run unchanged on a stream and on a batch.

``time`` names the event-time column; on a stream it carries the watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions import numbers, rules
from cardwatch.functions.numbers import count_if, mean, ratio, total
from cardwatch.operators.aggregates import mean_score, rows
from cardwatch.streaming.source import ARRIVAL

# Batch sessions are built from blocks of this length; it must not exceed the gap.
BLOCK_MS = 60_000
OTHERS = "_others"


def sliding(df: DataFrame, time: str = ARRIVAL, length: str = "5 minutes", slide: str = "1 minute",
            max_count: int = 10, max_amount: float = 10000, max_places: int = 3) -> DataFrame:
    """Rows, amounts and places per customer and sliding window, with three anomaly flags."""
    out = df.groupBy("customer_id", F.window(time, length, slide)).agg(
        rows().alias("tx_count"), total().alias("total_amount"), mean().alias("avg_amount"),
        F.max("amount").alias("max_amount"), F.array_sort(F.collect_set("location")).alias("locations"))
    return _flagged(_bounds(out, "window"), max_count, max_amount, max_places)


def _flagged(windows: DataFrame, max_count: int, max_amount: float, max_places: int) -> DataFrame:
    return windows.withColumns({
        "is_velocity_anomaly": F.col("tx_count") > max_count,
        "is_amount_anomaly": F.col("total_amount") > max_amount,
        "is_multi_location_anomaly": F.size("locations") > max_places,
    })


def panes(df: DataFrame, time: str = ARRIVAL, slide: str = "1 minute") -> DataFrame:
    """What sliding windows are put together from: sums, maximum and places per customer and slide.

    On a stream the state holds one entry for each of these, where ``sliding`` holds one for every window over it.
    """
    out = df.groupBy("customer_id", F.window(time, slide)).agg(
        rows().alias("_n"), F.sum(numbers.CENTS).alias("_cents"), F.count(numbers.CENTS).alias("_known"),
        F.max("amount").alias("max_amount"), F.collect_set("location").alias("locations"))
    return _bounds(out, "window")


def sliding_from_panes(panes_: DataFrame, length: int = 5, max_count: int = 10, max_amount: float = 10000,
                       max_places: int = 3) -> DataFrame:
    """The rows of ``sliding`` from a table of ``panes``, for windows of ``length`` slides.

    Panes are brought together by customer, who has at most one for each slide, before each is copied to its windows.
    """
    slide_us = F.unix_micros("window_end") - F.unix_micros("window_start")
    start = F.unix_micros("window_start") - F.col("_k") * slide_us
    placed = panes_.repartition("customer_id").withColumn("_k", F.explode(F.array(*[F.lit(k) for k in range(length)]))).select(
        "customer_id", F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + slide_us * length).alias("window_end"),
        "_n", "_cents", "_known", "max_amount", "locations")
    out = placed.groupBy("customer_id", "window_start", "window_end").agg(
        F.sum("_n").alias("tx_count"), numbers.money(F.sum("_cents")).alias("total_amount"),
        numbers.average(F.sum("_cents"), F.sum("_known")).alias("avg_amount"), F.max("max_amount").alias("max_amount"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("locations")))).alias("locations"))
    ordered = out.select("window_start", "window_end", "customer_id", *out.columns[3:])
    return _flagged(ordered, max_count, max_amount, max_places)


def anomalies(windows: DataFrame) -> DataFrame:
    return windows.where(F.col("is_velocity_anomaly") | F.col("is_amount_anomaly")
                         | F.col("is_multi_location_anomaly"))


def metrics(scored: DataFrame, time: str = ARRIVAL, length: str = "1 minute") -> DataFrame:
    """Volume and risk figures per fixed window."""
    hit, lvl = F.col("is_fraud_predicted"), F.col("risk_level")
    out = scored.groupBy(F.window(time, length)).agg(
        rows().alias("total_transactions"), total().alias("total_volume"), mean().alias("avg_amount"),
        count_if(hit).alias("fraud_count"), count_if(lvl == "CRITICAL").alias("critical_count"),
        count_if(lvl == "HIGH").alias("high_risk_count"), mean_score().alias("avg_fraud_score"),
        ratio(count_if(hit), rows()).alias("fraud_rate"))
    return _bounds(out, "window")


def _bounds(df: DataFrame, window: str) -> DataFrame:
    return df.select(F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"),
                     *[c for c in df.columns if c != window])


def _session_measures(time: Column) -> dict[str, Column]:
    """What a session keeps: sums, first and last place by (time, id), and its categories.

    The usual categories are kept as counts, so a session that never ends stays
    small; any other category, also a missing one, is kept by its name.
    """
    category = F.col("merchant_category")
    other = F.coalesce(~category.isin(*rules.CATEGORIES), F.lit(True))
    at = F.struct(time.alias("t"), F.col("transaction_id").alias("id"), F.col("location").alias("place"))
    named = F.struct(category.alias("category"), F.lit(1).cast("bigint").alias("row_count"))
    return {
        "_n": rows(), "_cents": F.sum("amount_cents"), "_first": F.min(at), "_last": F.max(at),
        **{f"_k{i}": count_if(category == c) for i, c in enumerate(rules.CATEGORIES)},
        OTHERS: F.collect_list(F.when(other, named)),
    }


def _merge_measures() -> dict[str, Column]:
    merged = {"_n": F.sum("_n"), "_cents": F.sum("_cents"), "_first": F.min("_first"), "_last": F.max("_last")}
    return merged | {f"_k{i}": F.sum(f"_k{i}") for i in range(len(rules.CATEGORIES))} | {
        OTHERS: F.flatten(F.collect_list(OTHERS))}


def _counted(named: Column) -> Column:
    """One entry per category of a list of (category, row_count)."""
    def one(category: Column) -> Column:
        own = F.filter(named, lambda e: e["category"].eqNullSafe(category))
        return F.struct(category.alias("category"), F.aggregate(
            own, F.lit(0).cast("bigint"), lambda total, e: total + e["row_count"]).alias("row_count"))
    return F.transform(F.array_sort(F.array_distinct(F.transform(named, lambda e: e["category"]))), one)


def _finish_sessions(df: DataFrame) -> DataFrame:
    counts = F.filter(F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"_k{i}").alias("row_count"))
                                for i, c in enumerate(rules.CATEGORIES)]), lambda e: e["row_count"] > 0)
    return _bounds(df, "session_window").select(
        "customer_id", F.col("window_start").alias("session_start"), F.col("window_end").alias("session_end"),
        F.col("_n").alias("session_tx_count"), numbers.money(F.col("_cents")).alias("session_total_amount"),
        F.col("_first.place").alias("first_location"), F.col("_last.place").alias("last_location"),
        F.concat(counts, _counted(F.col(OTHERS))).alias("merchant_categories"),
        (F.col("_first.place") != F.col("_last.place")).alias("has_location_change"),
        ((F.unix_millis("window_end") - F.unix_millis("window_start")) / F.lit(60_000))
        .alias("session_duration_minutes"))


def sessions(df: DataFrame, time: str = ARRIVAL, gap: str = "10 minutes") -> DataFrame:
    """Sessions per customer, closed by a gap. On a stream use append mode."""
    out = df.groupBy("customer_id", F.session_window(time, gap)).agg(
        *[m.alias(n) for n, m in _session_measures(F.col(time)).items()])
    return _finish_sessions(out)


def sessions_batch(df: DataFrame, time: str = ARRIVAL, gap_ms: int = 600_000, block_ms: int = BLOCK_MS) -> DataFrame:
    """The same sessions from a table, with rows first combined into short blocks per customer.

    Rows of one block are never further apart than the gap, so a block is one
    piece of a session that lasts from its first to its last row. Only blocks
    meet in the task of a customer.
    """
    if block_ms > gap_ms:
        raise ValueError("a block must not be longer than the gap")
    block = numbers.whole_div(F.unix_millis(time), F.lit(block_ms))
    blocks = df.groupBy("customer_id", block.alias("_block")).agg(
        F.min(time).alias("_from"), F.max(time).alias("_to"),
        *[m.alias(n) for n, m in _session_measures(F.col(time)).items()])
    blocks = blocks.withColumn(OTHERS, _counted(F.col(OTHERS)))
    lasting = F.concat((F.unix_micros("_to") - F.unix_micros("_from") + gap_ms * 1000).cast("string"),
                       F.lit(" microseconds"))
    out = blocks.groupBy("customer_id", F.session_window("_from", lasting)).agg(
        *[m.alias(n) for n, m in _merge_measures().items()])
    return _finish_sessions(out)

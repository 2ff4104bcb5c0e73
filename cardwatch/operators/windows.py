"""Window jobs per customer: running totals, velocity, history, travel, card testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions import numbers, rules, times
from cardwatch.functions.numbers import CENTS, money, whole_div
from cardwatch.operators import shape
from cardwatch.operators.shape import join_null_safe
from cardwatch.operators.spread import join_per_key
from cardwatch.operators.timeline import Timeline

LINE = Timeline()
TRAVEL_MS = 30 * times.MINUTE_MS
SMALL = 5


def _gap(ms_before: Column) -> Column:
    return F.col("timestamp_ms") - ms_before


def minutes(ms: Column) -> Column:
    return ms / F.lit(times.MINUTE_MS)


def _moved_fast(previous_place: Column, gap_ms: Column) -> Column:
    return F.coalesce((F.col("location") != previous_place) & (gap_ms < TRAVEL_MS), F.lit(False))


def rolling(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Running total and row number, and figures of the last ten rows."""
    ten = line.last_rows(9)
    cut = line.running(line.cut(df, back_rows=9), {"_sum": F.col(CENTS), "transaction_number": F.lit(1)})
    return line.close(cut.withColumns({
        "cumulative_amount": money(F.col("_sum")),
        "avg_last10": numbers.average(F.sum(CENTS).over(ten), F.count(CENTS).over(ten)),
        "max_last10": F.max("amount").over(ten),
        "count_last10": F.count("*").over(ten),
    })).drop("_sum")


def _last_ms(cut: DataFrame, ms: int, line: Timeline) -> DataFrame:
    counted = line.recent(cut, ms, {"tx_count_last_hour": F.lit(1), "_recent": F.col(CENTS)})
    return counted.withColumn("amount_last_hour", money(F.col("_recent"))).drop("_recent")


def velocity(df: DataFrame, max_count: int = 10, max_amount: float = 10000, window_ms: int = times.HOUR_MS,
             line: Timeline = LINE) -> DataFrame:
    """Rows and amount within the last hour, and whether either is unusual."""
    return line.close(_last_ms(line.cut(df), window_ms, line)).withColumn(
        "velocity_anomaly", (F.col("tx_count_last_hour") > max_count) | (F.col("amount_last_hour") > max_amount))


def history(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Mean, deviation and z-score against strictly earlier rows of the customer."""
    cents = F.col(CENTS)
    cut = line.running(line.cut(df), {"_n": F.lit(1), "_s1": cents, "_s2": numbers.square(cents)})
    n, s1, s2 = F.col("_n") - 1, F.col("_s1") - cents, F.col("_s2") - numbers.square(cents)
    out = line.close(cut).withColumns({
        "historical_avg": numbers.average(s1, n),
        "historical_std": numbers.deviation(n, s1, s2),
    }).drop("_n", "_s1", "_s2")
    usable = F.col("historical_std") > 0
    return out.withColumn("amount_zscore", F.when(usable, (F.col("amount") - F.col("historical_avg"))
                                                  / F.col("historical_std")).otherwise(F.lit(0.0)))


def batch_score(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Composite batch score: history z-score plus row rules."""
    return rules.apply(shape.enrich(history(df, line), risky=rules.RISKY), rules.BATCH)


def fraud_patterns(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Impossible travel (lag) and card testing (small amounts within the last five rows)."""
    order, five = line.window(), line.last_rows(4)
    cut = line.cut(df, back_rows=4).withColumns({
        "prev_location": F.lag("location").over(order),
        "prev_timestamp_ms": F.lag("timestamp_ms").over(order),
        "small_in_last5": F.count_if(F.col("amount") < SMALL).over(five),
    })
    gap = _gap(F.col("prev_timestamp_ms"))
    return line.close(cut).withColumns({
        "minutes_since_prev": minutes(gap),
        "impossible_travel": _moved_fast(F.col("prev_location"), gap),
        "small_amount": F.col("amount") < SMALL,
        "card_testing": F.col("small_in_last5") >= 3,
    })


def travel_list(df: DataFrame, n: int | None = 50, line: Timeline = LINE) -> DataFrame:
    """Impossible-travel hits, shortest gap first."""
    hits = fraud_patterns(df, line).where("impossible_travel").select(
        "customer_id", "transaction_id", "prev_location", F.col("location").alias("current_location"),
        F.col("minutes_since_prev").alias("minutes_between"), "amount")
    ordered = hits.orderBy("minutes_between", "transaction_id")
    return ordered if n is None else ordered.limit(n)


def velocity_trace(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Lag, travel flag, last-hour figures and sequence number in one pass over one partitioning."""
    order = line.window()
    cut = line.running(line.cut(df, back_rows=1), {"tx_sequence": F.lit(1)})
    cut = cut.withColumns({
        "prev_timestamp_ms": F.lag("timestamp_ms").over(order),
        "prev_location": F.lag("location").over(order),
    })
    cut = _last_ms(cut, times.HOUR_MS, line)
    gap = _gap(F.col("prev_timestamp_ms"))
    return line.close(cut).select(
        "transaction_id", "customer_id", "amount", "timestamp_ms", "prev_timestamp_ms",
        minutes(gap).alias("minutes_since_prev"), "prev_location", "location",
        _moved_fast(F.col("prev_location"), gap).alias("impossible_travel"),
        "tx_count_last_hour", "amount_last_hour", "tx_sequence")


def running_with_ties(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Running total in which rows of equal time share a value, change to the previous amount, rows per customer."""
    cut = line.running(line.cut(df, back_rows=1), {"tx_number": F.lit(1)})
    cut = line.upto(cut.withColumn("prev_amount", F.lag("amount").over(line.window())), {"_sum": F.col(CENTS)})
    rows = line.close(cut.withColumn("cumulative_amount", money(F.col("_sum")))).withColumn(
        "amount_change", F.col("amount") - F.col("prev_amount")).drop("_sum")
    return join_per_key(rows, df.groupBy(line.key).agg(F.count("*").alias("total_tx")), line.key)


def sequence(df: DataFrame, min_rows: int = 5, n: int | None = None, line: Timeline = LINE) -> DataFrame:
    """Row number, running total and whole minutes since the previous row of customers with enough rows."""
    sizes = df.groupBy(line.key).agg(F.count("*").alias("total_customer_tx"))
    active = join_per_key(df, sizes.where(F.col("total_customer_tx") >= min_rows), line.key, "inner")
    cut = line.running(line.cut(active, back_rows=1), {"tx_sequence": F.lit(1), "_sum": F.col(CENTS)})
    cut = cut.withColumn("_prev", F.lag("timestamp_ms").over(line.window()))
    out = line.close(cut).select(
        "customer_id", "transaction_id", "amount", "tx_sequence", money(F.col("_sum")).alias("cumulative_amount"),
        "total_customer_tx", whole_div(_gap(F.col("_prev")), F.lit(times.MINUTE_MS)).alias("minutes_since_last_tx"))
    return out if n is None else out.orderBy("customer_id", "tx_sequence").limit(n)


def pattern_pairs(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Neighbouring rows of a customer that travel too fast, test a card or jump in amount."""
    order = line.window()
    names = ("transaction_id", "amount", "location", "timestamp_ms", CENTS)
    cut = line.cut(df, back_rows=1).withColumns({f"_p_{c}": F.lag(c).over(order) for c in names})
    pairs = line.close(cut).where(F.col("_p_transaction_id").isNotNull())
    gap = _gap(F.col("_p_timestamp_ms"))
    travel = (F.col("_p_location") != F.col("location")) & (gap < TRAVEL_MS)
    both_small = (F.col("_p_amount") < SMALL) & (F.col("amount") < SMALL)
    jump = F.col(CENTS) > F.col(f"_p_{CENTS}") * 10
    return pairs.where(travel | both_small | jump).select(
        "customer_id", F.col("_p_transaction_id").alias("first_tx"), F.col("transaction_id").alias("second_tx"),
        F.col("_p_amount").alias("first_amount"), F.col("amount").alias("second_amount"),
        F.col("_p_location").alias("first_location"), F.col("location").alias("second_location"),
        minutes(gap).alias("minutes_between"),
        F.when(travel, "IMPOSSIBLE_TRAVEL")
        .when(both_small & (F.col(CENTS) > F.col(f"_p_{CENTS}")), "CARD_TESTING")
        .when(jump, "SUDDEN_INCREASE").otherwise("NORMAL").alias("pattern_type"))


def rankings(df: DataFrame, by: str = "merchant_category", top: int = 10) -> DataFrame:
    """Rank and percent rank of each amount within its category.

    Both depend on the amount only, so they are computed on the histogram of
    amounts and joined back; a category's rows never meet in one task. The
    histogram itself is ranked in coarse blocks of amounts first.
    """
    block = whole_div(F.col(CENTS), F.lit(10_000))
    histogram = df.groupBy(by, CENTS).agg(F.count("*").alias("_n")).withColumn("_block", block)
    higher = Window.partitionBy(by).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(by)
    blocks = (histogram.groupBy(by, "_block").agg(F.sum("_n").alias("_rows"))
              .select(by, "_block", F.coalesce(F.sum("_rows").over(higher), F.lit(0)).alias("_above"),
                      F.sum("_rows").over(everything).alias("_all")))
    inside = Window.partitionBy(by, "_block").orderBy(F.desc(CENTS)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (histogram.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .transform(lambda h: join_null_safe(h, blocks, [by, "_block"]))
             .select(by, CENTS, (F.col("_above") + F.col("_before") + 1).alias("rank_in_category"), "_all"))
    place = F.col("rank_in_category") - 1
    return join_null_safe(df, ranks, [by, CENTS]).withColumns({
        "percentile_in_category": F.when(F.col("_all") == 1, F.lit(0.0)).otherwise(
            place / F.nullif(F.col("_all") - 1, F.lit(0))),
        "is_top_transaction": F.col("rank_in_category") <= top,
    }).drop("_all")


def features(df: DataFrame, line: Timeline = LINE) -> DataFrame:
    """Model features: history z-score, rows in the last hour, gap, amount to average, change of place."""
    cents = F.col(CENTS)
    order = line.window()
    cut = line.running(line.cut(df, back_rows=1),
                       {"_n": F.lit(1), "_s1": cents, "_s2": numbers.square(cents)})
    cut = line.recent(cut, times.HOUR_MS, {"velocity_score": F.lit(1)}).withColumns({
        "_prev_ms": F.lag("timestamp_ms").over(order),
        "_prev_place": F.lag("location").over(order),
    })
    n, s1, s2 = F.col("_n") - 1, F.col("_s1") - cents, F.col("_s2") - numbers.square(cents)
    avg, std = F.col("_avg"), F.col("_std")
    # Columns of their own, as an expression used several times would be computed as often.
    moments = line.close(cut).withColumn("_spread", numbers.spread(n, s1, s2)).withColumns({
        "_avg": numbers.average(s1, n), "_std": numbers.deviation_of(n, F.col("_spread"))})
    return moments.withColumns({
        "hour": times.hour_of_day(),
        "day_of_week": times.day_of_week(),
        "amount_zscore": F.when(std > 0, (F.col("amount") - avg) / std).otherwise(F.lit(0.0)),
        "time_since_last_tx": F.coalesce(_gap(F.col("_prev_ms")), F.lit(0)),
        "avg_amount_ratio": F.coalesce(F.col("amount") / F.nullif(avg, F.lit(0.0)), F.lit(1.0)),
        "location_changed": F.coalesce(F.col("location") != F.col("_prev_place"), F.lit(False)),
        "is_high_risk": (F.col("amount") > 5000) | F.col("merchant_category").isin(*rules.RISKY_WITH_WIRE),
    }).drop("_n", "_s1", "_s2", "_spread", "_avg", "_std", "_prev_ms", "_prev_place")

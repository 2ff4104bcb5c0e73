"""Reports over the scored table: risk shares, confusion tables, trends, alerts, top lists.

"Now" is an argument everywhere; left out, it is the latest event in the input,
read by a scalar subquery inside the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions import numbers, rules, times
from cardwatch.functions.numbers import count_if, mean, percent, ratio, total, total_if, whole_div
from cardwatch.operators.aggregates import bin_of, labelled, mean_score, mean_score_4, rows

HIT = "is_fraud_predicted"
# Decision thresholds of the precision-recall table, in hundredths.
PR_THRESHOLDS = (10, 20, 30, 40, 50, 60, 70, 80, 90)


def latest_ms(df: DataFrame) -> Column:
    return df.agg(F.max("timestamp_ms")).scalar()


def last_days(df: DataFrame, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the day of ``as_of`` (a date column expression) and of ``days`` days before it.

    The bounds are on the time itself, and on the date column where a table has one, so files and folders outside
    are not read.
    """
    today = F.to_date(F.timestamp_millis(latest_ms(df))) if as_of is None else as_of
    first, time = F.date_sub(today, days), F.col("timestamp_ms")
    out = df.where((time >= _midnight(first)) & (time < _midnight(F.date_add(today, 1))))
    if "transaction_date" in df.columns:
        out = out.where(F.col("transaction_date").between(first, today))
    return out


def _midnight(date: Column) -> Column:
    """First millisecond of a day, UTC."""
    return F.unix_date(date).cast("bigint") * 86_400_000


def last_ms(df: DataFrame, ms: int, as_of_ms: Column | None = None) -> DataFrame:
    now = latest_ms(df) if as_of_ms is None else as_of_ms
    return df.where((F.col("timestamp_ms") > now - ms) & (F.col("timestamp_ms") <= now))


def high_risk_list(df: DataFrame) -> DataFrame:
    """First matching reason, level by OR-rules, most severe and largest first."""
    hour = times.hour_of_day()
    foreign, night = F.col("is_international"), times.is_night(hour)
    amount, category = F.col("amount"), F.col("merchant_category")
    wire, risky = category.isin(*rules.RISKY_WITH_WIRE), category.isin(*rules.RISKY)
    reason = (("VERY_HIGH_AMOUNT", amount > 10000), ("HIGH_AMOUNT", amount > 5000),
              ("HIGH_INTERNATIONAL", rules.foreign_over(1000)()), ("RISKY_MERCHANT", wire),
              ("SUSPICIOUS_HOUR", night))
    level = (("CRITICAL", (amount > 10000) | rules.foreign_over(5000)() | risky),
             ("HIGH", (amount > 5000) | rules.foreign_over(1000)() | night), ("MEDIUM", amount > 1000))

    def first_of(pairs: Sequence[tuple[str, Column]], rest: str) -> Column:
        return reduce(lambda chain, p: chain.when(p[1], p[0]), pairs, F).otherwise(rest)

    listed = df.where((amount > 1000) | foreign | wire | night).select(
        "transaction_id", "customer_id", "amount", "merchant_category", "location", "is_international",
        hour.alias("hour"), first_of(reason, "NORMAL").alias("risk_reason"), first_of(level, "LOW").alias("risk_level"))
    return listed.orderBy(rules.level_rank(F.col("risk_level")), F.desc("amount"), "transaction_id")


def high_risk_short(df: DataFrame, n: int | None = 15) -> DataFrame:
    """Three reasons and three levels, largest amounts only."""
    amount, risky = F.col("amount"), F.col("merchant_category").isin(*rules.RISKY)
    listed = df.where((amount > 1000) | risky).select(
        "transaction_id", "customer_id", "amount", "merchant_category",
        F.when(amount > 5000, "VERY_HIGH_AMOUNT").when(risky, "RISKY_MERCHANT")
        .when(rules.foreign_over(1000)(), "HIGH_INTERNATIONAL").otherwise("NORMAL").alias("risk_reason"),
        F.when((amount > 5000) | risky, "HIGH").when(amount > 1000, "MEDIUM").otherwise("LOW").alias("risk_level"),
        "is_fraud")
    return listed if n is None else listed.orderBy(F.desc("amount"), "transaction_id").limit(n)


def overview(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("total_transactions"), total().alias("total_volume"),
                  mean().alias("avg_transaction_amount"), F.count_distinct("customer_id").alias("unique_customers"),
                  F.count_distinct("merchant_id").alias("unique_merchants"), labelled().alias("total_frauds"),
                  percent(labelled(), rows(), 4).alias("fraud_rate_percent"),
                  total_if(F.col("is_fraud")).alias("fraud_volume"))


def overview_scored(scored: DataFrame) -> DataFrame:
    return scored.agg(rows().alias("total_transactions"), F.count_distinct("customer_id").alias("unique_customers"),
                      F.count_distinct("merchant_id").alias("unique_merchants"), total().alias("total_volume"),
                      numbers.mean_rounded().alias("avg_transaction"), F.max("amount").alias("max_transaction"),
                      labelled().alias("actual_frauds"), count_if(F.col(HIT)).alias("predicted_frauds"),
                      count_if(F.col("alert_required")).alias("alerts_generated"))


def top_fraud_merchants(df: DataFrame, label: str = "is_fraud", min_rows: int = 1, min_frauds: int = 1,
                        n: int = 20) -> DataFrame:
    hit = F.col(label)
    return (df.groupBy("merchant_id", "merchant_category").agg(
        rows().alias("total_transactions"), total().alias("total_volume"), count_if(hit).alias("fraud_count"),
        total_if(hit).alias("fraud_volume"), percent(count_if(hit), rows()).alias("fraud_rate"))
        .where((F.col("total_transactions") >= min_rows) & (F.col("fraud_count") >= min_frauds))
        .orderBy(F.desc("fraud_rate"), F.desc("fraud_volume"), "merchant_id").limit(n))


def risk_share(scored: DataFrame, by_subquery: bool = False) -> DataFrame:
    """Rows per level and their share, the total taken from a window over the few levels or from a subquery."""
    levels = scored.groupBy("risk_level").agg(
        rows().alias("transaction_count"), total().alias("total_amount"), mean_score_4().alias("avg_fraud_score"),
        labelled().alias("actual_frauds"))
    everything = scored.agg(rows()).scalar() if by_subquery else F.sum("transaction_count").over(Window.partitionBy())
    return (levels.withColumn("percentage", percent(F.col("transaction_count"), everything))
            .orderBy(rules.level_rank(F.col("risk_level"))))


def risk_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_level").agg(rows().alias("transaction_count")).orderBy(
        rules.level_rank(F.col("risk_level")))


def confusion(scored: DataFrame, by: Sequence[str] = (), label: str = "is_fraud",
              predicted: Column | None = None) -> DataFrame:
    """Confusion counts, precision, recall and F1; null labels are in no cell."""
    guess = F.col(HIT) if predicted is None else predicted
    truth = F.col(label)
    tp, fp = count_if(guess & truth), count_if(guess & ~truth)
    fn, tn = count_if(~guess & truth), count_if(~guess & ~truth)
    return scored.groupBy(*by).agg(
        tp.alias("true_positives"), fp.alias("false_positives"), fn.alias("false_negatives"),
        tn.alias("true_negatives"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def confusion_by_day(scored: DataFrame, threshold: int = 70, label: str = "is_fraud") -> DataFrame:
    dated = scored.withColumn("prediction_date", times.event_date())
    return confusion(dated, ["prediction_date"], label, F.col("score_points") >= threshold).orderBy("prediction_date")


def model_by_level(scored: DataFrame) -> DataFrame:
    guess, truth = F.col(HIT), F.col("is_fraud")
    return scored.groupBy("risk_level").agg(
        rows().alias("total_count"), labelled().alias("actual_frauds"), count_if(guess).alias("predicted_frauds"),
        count_if(guess & truth).alias("true_positives"), count_if(guess & ~truth).alias("false_positives"),
        count_if(~guess & truth).alias("false_negatives"), count_if(~guess & ~truth).alias("true_negatives"),
        mean_score_4().alias("avg_fraud_score"))


def precision_recall(scored: DataFrame, thresholds: Sequence[int] = PR_THRESHOLDS, points: str = "score_points",
                     label: str = "is_fraud") -> DataFrame:
    """One row per threshold.

    Scores are whole hundredths, so the rows are first counted per score; only
    these counts meet the thresholds.
    """
    counts = scored.groupBy(points).agg(rows().alias("_n"), labelled(label).alias("_fraud"))
    at = counts.withColumn("_t", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    hit = F.col(points) >= F.col("_t")
    positive, true_positive = (F.sum(F.when(hit, F.col(c)).otherwise(0)) for c in ("_n", "_fraud"))
    return at.groupBy("_t").agg(
        F.sum("_n").alias("total"), positive.alias("predicted_positive"), true_positive.alias("true_positive"),
        ratio(true_positive, positive).alias("precision"), ratio(true_positive, F.sum("_fraud")).alias("recall"),
    ).select((F.col("_t") / F.lit(100)).alias("threshold"), "total", "predicted_positive", "true_positive",
             "precision", "recall").orderBy("threshold")


def correlations(scored: DataFrame, features: dict[str, Column], outcome: Column | None = None) -> DataFrame:
    """Correlation of whole-number features with a yes/no outcome, all features in one pass."""
    y = F.coalesce(F.col(HIT) if outcome is None else outcome, F.lit(False)).cast("bigint")
    sums = {"_n": rows(), "_y": F.sum(y)}
    for i, x in enumerate(features.values()):
        x = x.cast("bigint")
        wide = x.cast("decimal(19,0)")
        sums |= {f"_x{i}": F.sum(wide), f"_xx{i}": F.sum(numbers.square(x)), f"_xy{i}": F.sum(wide * y)}
    one = scored.agg(*[m.alias(n) for n, m in sums.items()])
    n, sy = F.col("_n"), F.col("_y")

    def corr(i: int) -> Column:
        sx, sxx, sxy = (F.col(f"_{c}{i}") for c in ("x", "xx", "xy"))
        bottom = F.sqrt(numbers.co_moment(n, sx, sx, sxx)) * F.sqrt(numbers.co_moment(n, sy, sy, sy))
        return numbers.co_moment(n, sx, sy, sxy) / F.nullif(bottom, F.lit(0.0))

    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("feature"), corr(i).alias("correlation"))
                                          for i, name in enumerate(features)])).alias("_r")).select("_r.*")


def score_deciles(scored: DataFrame, tiles: int = 10, slot_ms: int = times.MINUTE_MS) -> DataFrame:
    """NTILE over the score (ties by time and id) without sorting all rows in one task.

    Rows are counted per (score, time slot). Running totals of these counts say
    which tile each cell belongs to; only the few cells that a tile border cuts
    are looked at row by row.
    """
    slot = times.slot_start(slot_ms)
    keys = ["score_points", "_slot"]
    rows_in = scored.select("score_points", "timestamp_ms", "transaction_id", HIT, slot.alias("_slot"))
    cells = rows_in.groupBy(*keys).agg(rows().alias("_n"), count_if(F.col(HIT)).alias("_hits"))
    # Two-level running totals: scores are few, slots are ordered within their score.
    scores = cells.groupBy("score_points").agg(F.sum("_n").alias("_rows"))
    upto = Window.partitionBy().orderBy("score_points").rowsBetween(Window.unboundedPreceding, -1)
    scores = scores.select("score_points", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_lower"),
                           F.sum("_rows").over(Window.partitionBy()).alias("_all"))
    within = Window.partitionBy("score_points").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = (cells.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
              .join(F.broadcast(scores), "score_points")
              .withColumn("_start", F.col("_lower") + F.col("_before")))

    def tile(position: Column) -> Column:
        """Tile (1-based) of a 0-based position: the first ``all % tiles`` tiles have one row more."""
        size, longer = whole_div(F.col("_all"), F.lit(tiles)), F.col("_all") % tiles
        border = longer * (size + 1)
        return (F.when(position < border, whole_div(position, size + 1))
                .otherwise(longer + whole_div(position - border, F.greatest(size, F.lit(1)))) + 1)

    first, last = tile(F.col("_start")), tile(F.col("_start") + F.col("_n") - 1)
    tiled = placed.withColumns({"decile": first, "_last": last})
    whole = tiled.where(F.col("decile") == F.col("_last")).select("decile", "score_points", "_n", "_hits")
    # At most tiles - 1 cells are cut by a border.
    cut = tiled.where(F.col("decile") != F.col("_last")).select(*keys, "_start", "_all").limit(tiles - 1)
    order = Window.partitionBy(*keys).orderBy("timestamp_ms", "transaction_id")
    single = (rows_in.join(F.broadcast(cut), keys)
              .select(tile(F.col("_start") + F.row_number().over(order) - 1).alias("decile"), "score_points",
                      F.lit(1).cast("bigint").alias("_n"), F.coalesce(F.col(HIT), F.lit(False)).cast("bigint").alias("_hits")))
    return (whole.unionByName(single).groupBy("decile").agg(
        (F.min("score_points") / F.lit(100)).alias("min_score"), (F.max("score_points") / F.lit(100)).alias("max_score"),
        F.sum("_n").alias("transaction_count"), F.sum("_hits").alias("actual_frauds")).orderBy("decile"))


def minute_metrics(scored: DataFrame, ms: int = times.HOUR_MS, as_of_ms: Column | None = None) -> DataFrame:
    return last_ms(scored, ms, as_of_ms).groupBy(F.date_trunc("minute", times.event_time()).alias("minute")).agg(
        rows().alias("transactions"), total().alias("volume"), count_if(F.col(HIT)).alias("frauds"),
        mean_score().alias("avg_score")).orderBy(F.desc("minute"))


def daily_summary(scored: DataFrame, days: int = 7, as_of: Column | None = None) -> DataFrame:
    hit = F.col(HIT)
    return last_days(scored, days, as_of).groupBy(times.event_date().alias("transaction_date")).agg(
        rows().alias("total_transactions"), total().alias("total_volume"), count_if(hit).alias("fraud_count"),
        total_if(hit).alias("fraud_volume"), mean_score().alias("avg_fraud_score"),
        F.count_distinct("customer_id").alias("unique_customers")).orderBy(F.desc("transaction_date"))


def category_risk(scored: DataFrame, days: int = 7, as_of: Column | None = None) -> DataFrame:
    return last_days(scored, days, as_of).groupBy("merchant_category", "risk_level").agg(
        rows().alias("transaction_count"), total().alias("total_volume"), mean().alias("avg_amount"),
        mean_score().alias("avg_fraud_score"), count_if(F.col(HIT)).alias("fraud_count")
    ).orderBy("merchant_category", "risk_level")


def model_daily(predictions: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """Predictions per day and model version."""
    return last_days(predictions, days, as_of).groupBy(times.event_date().alias("prediction_date"),
                                                       "model_version").agg(
        rows().alias("total_predictions"), count_if(F.col(HIT)).alias("fraud_predictions"),
        mean_score().alias("avg_probability"), F.max("fraud_score").alias("max_probability")
    ).orderBy(F.desc("prediction_date"), "model_version")


def moving_average(scored: DataFrame, days: int = 7) -> DataFrame:
    """Daily figures with the moving average of the daily counts (one row per day, so one small window)."""
    daily = scored.groupBy(times.event_date().alias("transaction_date")).agg(
        rows().alias("daily_transactions"), total().alias("daily_volume"), labelled().alias("daily_frauds"),
        count_if(F.col("alert_required")).alias("daily_alerts"), mean_score_4().alias("avg_fraud_score"))
    recent = Window.partitionBy().orderBy("transaction_date").rowsBetween(-(days - 1), 0)
    n = F.count("*").over(recent)
    return daily.withColumn("moving_avg_tx", numbers.rounded(F.sum("daily_transactions").over(recent), n)).orderBy(
        F.desc("transaction_date"))


def week_over_week(scored: DataFrame, days: int = 14, as_of: Column | None = None) -> DataFrame:
    """Each day against the same weekday one week before.

    The days are aggregated once; the earlier day is looked up by its distance
    among these few rows.
    """
    daily = last_days(scored, days + 7, as_of).groupBy(times.event_date().alias("date")).agg(
        rows().alias("current_transactions"), count_if(F.col(HIT)).alias("current_frauds"))
    week_before = Window.partitionBy().orderBy(F.unix_date("date")).rangeBetween(-7, -7)
    today = F.to_date(F.timestamp_millis(latest_ms(scored))) if as_of is None else as_of

    def change(now: str, then: str) -> Column:
        return (F.col(now) - F.col(then)) * 100 / F.nullif(F.col(then), F.lit(0))

    compared = daily.withColumns({
        "prev_week_transactions": F.sum("current_transactions").over(week_before),
        "prev_week_frauds": F.sum("current_frauds").over(week_before),
    })
    return compared.where(F.col("date") >= F.date_sub(today, days)).withColumns({
        "tx_change_percent": change("current_transactions", "prev_week_transactions"),
        "fraud_change_percent": change("current_frauds", "prev_week_frauds"),
    }).orderBy("date")


def risky_customers(scored: DataFrame, min_rows: int = 3, n: int = 20) -> DataFrame:
    """Customers with the highest mean score. The rank is given after the top n are found."""
    stats = scored.groupBy("customer_id").agg(
        rows().alias("total_transactions"), total().alias("total_spent"),
        numbers.mean_rounded().alias("avg_transaction"), mean_score_4().alias("avg_fraud_score"),
        labelled().alias("fraud_count"), count_if(F.col("alert_required")).alias("alert_count"))
    order = [F.desc("avg_fraud_score"), F.col("customer_id")]
    top = stats.where(F.col("total_transactions") >= min_rows).orderBy(*order).limit(n)
    return top.withColumn("risk_rank", F.row_number().over(Window.partitionBy().orderBy(*order)))


def alert_summary(scored: DataFrame) -> DataFrame:
    """Alerts per risk level with distinct customers and merchants."""
    return scored.where(F.col("alert_required")).groupBy("risk_level").agg(
        rows().alias("alert_count"), total().alias("total_amount"), numbers.mean_rounded().alias("avg_amount"),
        mean_score_4().alias("avg_fraud_score"), F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_id").alias("unique_merchants")).orderBy(rules.level_rank(F.col("risk_level")))


def open_alerts(alerts: DataFrame, as_of: Column | None = None, days: int = 1) -> DataFrame:
    """Open alerts per level since yesterday."""
    recent = last_days(alerts.where(F.col("status") == "OPEN"), days, as_of)
    return recent.groupBy("alert_level").agg(
        rows().alias("alert_count"), mean_score().alias("avg_score"), total().alias("total_amount")
    ).orderBy(F.when(F.col("alert_level") == "CRITICAL", 1).otherwise(2))


def end_of_day(scored: DataFrame, as_of: Column | None = None) -> DataFrame:
    hit = F.col(HIT)
    return last_days(scored, 0, as_of).agg(
        rows().alias("total_transactions"), total().alias("total_volume"), count_if(hit).alias("frauds_detected"),
        total_if(hit).alias("fraud_volume_blocked"), mean_score().alias("avg_fraud_score"),
        F.count_distinct("customer_id").alias("unique_customers"),
        count_if(F.col("risk_level") == "CRITICAL").alias("critical_transactions"))


def top_categories(scored: DataFrame, n: int = 3, as_of: Column | None = None) -> DataFrame:
    """Categories with most detected frauds on the last day."""
    return (last_days(scored, 0, as_of).groupBy("merchant_category").agg(
        count_if(F.col(HIT)).alias("frauds"), rows().alias("transactions"))
        .orderBy(F.desc("frauds"), F.desc("transactions"), "merchant_category").limit(n))


def chart_data(scored: DataFrame) -> DataFrame:
    """Data sets behind the charts in long form: amount and score histograms, category and level counts.

    One scan; every row counts once in each chart, and the counts are combined before the shuffle.
    """
    labels = {"amount": bin_of("amount", 0, 20000, 50), "score": bin_of("score_points", 0, 120, 30),
              "category": F.col("merchant_category"), "risk": F.col("risk_level")}
    entries = F.array(*[F.struct(F.lit(chart).alias("chart"), label.cast("string").alias("label"))
                        for chart, label in labels.items()])
    return (scored.select(F.explode(entries).alias("_e")).groupBy("_e.chart", "_e.label")
            .agg(rows().alias("row_count")))


def daily_report(day: DataFrame, categories: int = 3) -> DataFrame:
    """One row for a day's scored rows: volume, rate, blocked amount, categories hit most, and quality of the rules."""
    hit, truth = F.coalesce(F.col(HIT), F.lit(False)), F.col("is_fraud")
    tp, fp, fn = count_if(hit & truth), count_if(hit & ~truth), count_if(~hit & truth)
    figures = day.agg(
        rows().alias("total_transactions"), count_if(hit).alias("frauds_detected"), ratio(count_if(hit), rows()).alias("fraud_rate"),
        F.coalesce(total_if(hit), F.lit(0.0)).alias("blocked_amount"), tp.alias("true_positives"), fp.alias("false_positives"),
        fn.alias("false_negatives"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
    counts = day.where(hit & F.col("merchant_category").isNotNull()).groupBy("merchant_category").agg(rows().alias("_n"))
    most = counts.orderBy(F.desc("_n"), "merchant_category").limit(categories).agg(
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_n")).alias("n"), "merchant_category"))),
                    lambda e: e["merchant_category"]).alias("_top"))
    return figures.withColumn("top_categories", most.scalar())

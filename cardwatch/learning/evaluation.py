"""Areas under both curves and the confusion cells of any number of models, from one histogram of their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.numbers import ratio
from cardwatch.session import staged


def evaluate_scores(scored: DataFrame, blocks: int = 1024) -> DataFrame:
    """A row per model of (model, score, prediction, label): areas, accuracy, precision, recall, F1, confusion cells.

    Rows are counted per model and score in one pass; all figures follow from these counts, exactly: the area under ROC
    is the share of pairs of a positive and a negative that the score puts in order, ties for half, and the area under
    precision and recall goes through the points of all distinct scores. Scores are ranked in blocks first, so no task
    ranks all scores of a model. Rows without a label, and scores that are null or not a number, do not count.
    """
    known = scored.where(F.col("label").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score"))
    truth, guess = F.col("label") == 1, F.col("prediction") == 1
    cells = {"true_positives": guess & truth, "false_positives": guess & ~truth, "false_negatives": ~guess & truth,
             "true_negatives": ~guess & ~truth}
    counts = known.groupBy("model", F.col("score").cast("double").alias("score")).agg(
        F.count_if(truth).alias("_pos"), F.count_if(~truth).alias("_neg"), *[F.count_if(c).alias(n) for n, c in cells.items()])
    counts = staged(scored.sparkSession, counts, "score-counts")
    ends = counts.groupBy("model").agg(F.min("score").alias("_low"), F.max("score").alias("_high"))
    place = F.when(F.col("_high") > F.col("_low"), (F.col("score") - F.col("_low")) / (F.col("_high") - F.col("_low")))
    # one row per model
    counts = counts.join(ends, "model").withColumn("_block", F.floor(F.coalesce(place, F.lit(0.0)) * blocks)).drop("_low", "_high")
    above = "over (partition by model order by _block desc rows between unbounded preceding and 1 preceding)"
    sums = counts.groupBy("model", "_block").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")).select(
        "model", "_block", F.expr(f"coalesce(sum(_p) {above}, 0L)").alias("_p0"), F.expr(f"coalesce(sum(_n) {above}, 0L)").alias("_n0"),
        F.expr("sum(_p) over (partition by model)").alias("_all_pos"), F.expr("sum(_n) over (partition by model)").alias("_all_neg"))
    before = "over (partition by model, _block order by score desc rows between unbounded preceding and 1 preceding)"
    ranked = counts.join(sums, ["model", "_block"]).withColumns({
        "_p0": F.col("_p0") + F.expr(f"coalesce(sum(_pos) {before}, 0L)"),
        "_n0": F.col("_n0") + F.expr(f"coalesce(sum(_neg) {before}, 0L)")})
    pairs = F.col("_neg").cast("decimal(19,0)") * (2 * F.col("_p0") + F.col("_pos")).cast("decimal(19,0)")
    now = ratio(F.col("_p0") + F.col("_pos"), F.col("_p0") + F.col("_pos") + F.col("_n0") + F.col("_neg"))
    precision0 = F.coalesce(ratio(F.col("_p0"), F.col("_p0") + F.col("_n0")), now)
    step = ratio(F.col("_pos"), F.col("_all_pos")) * (now + precision0) / 2
    tp, fp, fn, tn = (F.sum(n) for n in cells)
    most = F.max("_all_pos").cast("double") * F.max("_all_neg")
    return ranked.groupBy("model").agg(
        (F.sum(pairs).cast("double") / F.nullif(2 * most, F.lit(0.0))).alias("auc_roc"), F.sum(step).alias("auc_pr"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        *[F.sum(n).alias(n) for n in cells])

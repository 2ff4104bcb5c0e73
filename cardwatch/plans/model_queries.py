"""Feature preparation and the classifiers, trained on the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.learning import evaluation, model, split
from cardwatch.operators import shape, windows
from cardwatch.plans.catalog import query, scored, tx_balance
from cardwatch.plans.stream_queries import transactions, written
from cardwatch.session import fresh_path, staged


@query("ml_prepare", """SELECT transaction_id, amount, COALESCE(previous_balance, 0) AS previous_balance,
    CAST(hour AS DOUBLE) AS hour, CAST(day_of_week AS DOUBLE) AS day_of_week,
    CAST(is_international AS BIGINT) AS is_international_num, CAST(is_fraud AS DOUBLE) AS label FROM enriched""")
def _(spark, sf):
    return model.prepare(tx_balance(spark, sf)).select("transaction_id", "amount", "previous_balance", "hour",
                                                       "day_of_week", "is_international_num", "label")


def prepared(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and test part with window features, written once for the many passes of training."""
    columns = ["transaction_id", "customer_id", *model.CATEGORICAL, *model.NUMERIC, "is_international_num", "label"]
    rows = model.prepare(windows.features(tx_balance(spark, sf))).select(*columns)
    return model.split(staged(spark, rows, "features"))


SIDE = "CAST('0x' || substr(md5('42:' || transaction_id), 1, 8) AS BIGINT) % 10000 < 2000"


@query("ml_split", f"""SELECT {SIDE} AS held_out, is_fraud, COUNT(*) AS row_count FROM tx GROUP BY 1, 2""")
def _(spark, sf):
    """Rows and labels on both sides of the split."""
    train, test = model.split(tx_balance(spark, sf))
    both = train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))
    return both.groupBy("held_out", "is_fraud").agg(F.count("*").alias("row_count"))


@query("ml_predict_check", f"""SELECT COUNT(*) AS row_count, 0::BIGINT AS wrong_flags, 0::BIGINT AS wrong_levels,
    COUNT(*) FILTER (WHERE {SIDE}) AS held_out FROM tx""")
def _(spark, sf):
    """Every row is scored, also with gaps in flags and amounts of others; flag and level follow the probability."""
    train, test = prepared(spark, sf)
    fitted = model.train(train, model.logistic_regression(), prepared=True)
    gaps = tx_balance(spark, sf).withColumns({
        "is_international": F.when(F.col("timestamp_ms") % 3 > 0, F.col("is_international")),
        "merchant_category": F.when(F.col("timestamp_ms") % 5 > 0, F.col("merchant_category"))})
    p, level = F.col("fraud_probability"), F.col("risk_level")
    right = F.when(p >= 0.9, "CRITICAL").when(p >= 0.7, "HIGH").when(p >= 0.5, "MEDIUM").otherwise("LOW")
    held = test.select("transaction_id", F.lit(1).alias("_held"))
    return model.predict(fitted, gaps).join(held, "transaction_id", "left").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("is_fraud_predicted") != (p >= 0.5)).alias("wrong_flags"),
        F.count_if(level != right).alias("wrong_levels"), F.count("_held").alias("held_out"))


CLASSIFIERS = {
    "logistic_regression": lambda: model.logistic_regression(),
    "random_forest": lambda: model.random_forest(),
    "boosted_trees": lambda: model.boosted_trees(),
}


def held_out_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of three classifiers on the held-out part, each row scored once by each."""
    train, test = prepared(spark, sf)
    fitted = model.train_all(train, {name: make() for name, make in CLASSIFIERS.items()}, prepared=True, from_counts=True)
    return shape.union_batches([model.scores(one.transform(test), name) for name, one in fitted.items()])


@query("ml_evaluate")
def _(spark, sf):
    """Metrics of three classifiers on the held-out part."""
    return evaluation.evaluate_scores(held_out_scores(spark, sf))


@query("ml_best")
def _(spark, sf):
    return model.best([evaluation.evaluate_scores(held_out_scores(spark, sf))])


AREAS = """, s AS (SELECT 'rules' AS model, fraud_score AS score, is_fraud_predicted AS guess, is_fraud FROM scored WHERE is_fraud IS NOT NULL
    UNION ALL SELECT 'amount', amount, amount > 1000, is_fraud FROM scored WHERE is_fraud IS NOT NULL),
  h AS (SELECT model, score, COUNT(*) FILTER (WHERE is_fraud) AS p, COUNT(*) FILTER (WHERE NOT is_fraud) AS n FROM s GROUP BY ALL),
  c AS (SELECT *, CAST(SUM(p) OVER w AS DOUBLE) AS tp, CAST(SUM(n) OVER w AS DOUBLE) AS fp, SUM(p) OVER (PARTITION BY model) AS ps,
    SUM(n) OVER (PARTITION BY model) AS ns FROM h WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
  k AS (SELECT model, ROUND(CAST(SUM(n * (2 * tp - p)) AS DOUBLE) / (2.0 * MAX(ps) * MAX(ns)), 9) AS auc_roc,
    ROUND(SUM(p / ps * (tp / (tp + fp) + CASE WHEN tp + fp > p + n THEN (tp - p) / (tp + fp - p - n) ELSE tp / (tp + fp) END) / 2), 9) AS auc_pr
    FROM c GROUP BY model)
  SELECT model, auc_roc, auc_pr, COUNT(*) FILTER (WHERE guess AND is_fraud) AS true_positives,
    COUNT(*) FILTER (WHERE guess AND NOT is_fraud) AS false_positives, COUNT(*) FILTER (WHERE NOT guess AND is_fraud) AS false_negatives,
    COUNT(*) FILTER (WHERE NOT guess AND NOT is_fraud) AS true_negatives FROM s JOIN k USING (model) GROUP BY 1, 2, 3"""


@query("ml_areas", AREAS)
def _(spark, sf):
    """The same figures for two scores that need no training: the rules and the plain amount."""
    rows = scored(spark, sf).withColumn("label", F.col("is_fraud").cast("double"))
    both = rows.select(F.lit("rules").alias("model"), F.col("fraud_score").alias("score"),
                       F.col("is_fraud_predicted").cast("double").alias("prediction"), "label").unionByName(
        rows.select(F.lit("amount").alias("model"), F.col("amount").alias("score"),
                    (F.col("amount") > 1000).cast("double").alias("prediction"), "label"))
    return evaluation.evaluate_scores(both).select(
        "model", F.round("auc_roc", 9).alias("auc_roc"), F.round("auc_pr", 9).alias("auc_pr"), "true_positives",
        "false_positives", "false_negatives", "true_negatives")


@query("ml_split_exact", """, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY is_fraud ORDER BY
      CAST('0x' || substr(md5('42:' || transaction_id), 1, 15) AS BIGINT), transaction_id) AS place,
      FLOOR(COUNT(*) OVER (PARTITION BY is_fraud) * 0.2 + 0.5) AS wanted FROM tx)
    SELECT place <= wanted AS held_out, is_fraud, COUNT(*) AS row_count, MIN(transaction_id) AS first_id,
      MAX(transaction_id) AS last_id, SUM(amount_cents)::BIGINT AS cents FROM r GROUP BY 1, 2""")
def _(spark, sf):
    """An exact fifth of every class, row by row the same as sorting by the seeded hash."""
    train, test = split.stratified(tx_balance(spark, sf))
    both = train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))
    return both.groupBy("held_out", "is_fraud").agg(
        F.count("*").alias("row_count"), F.min("transaction_id").alias("first_id"), F.max("transaction_id").alias("last_id"),
        F.sum("amount_cents").alias("cents"))


@query("ml_predict")
def _(spark, sf):
    """All rows scored by a forest trained on the training part, index-only features."""
    train, test = prepared(spark, sf)
    fitted = model.train(train, model.random_forest(min_rows=5, subset="sqrt"), one_hot=False, prepared=True)
    return model.predict(fitted, train.unionByName(test), prepared=True)


@query("ml_importance")
def _(spark, sf):
    train, _ = prepared(spark, sf)
    fitted = model.train(train, model.random_forest(), prepared=True)
    return model.importance(spark, fitted, fitted.transform(train))


@query("ml_reload", "SELECT COUNT(*) AS row_count, 0::BIGINT AS differing FROM tx")
def _(spark, sf):
    """A saved and loaded model gives the same probabilities."""
    train, test = prepared(spark, sf)
    fitted, path = model.train(train, model.logistic_regression(), prepared=True), fresh_path(spark, "model")
    model.save(fitted, path)
    rows = train.unionByName(test)
    before, after = (model.predict(m, rows, prepared=True).select("transaction_id", F.col("fraud_probability").alias(n))
                     for m, n in ((fitted, "before"), (model.load(path), "after")))
    return before.join(after, "transaction_id").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("before") != F.col("after")).alias("differing"))


@query("ml_stream", "SELECT COUNT(*) AS row_count, COUNT(DISTINCT transaction_id) AS ids FROM tx")
def _(spark, sf):
    """A stream scored with a trained model."""
    train, _ = prepared(spark, sf)
    fitted = model.train(train, model.logistic_regression(), prepared=True)
    out = written(spark, model.predict(fitted, transactions(spark, sf)))
    return out.agg(F.count("*").alias("row_count"), F.count_distinct("transaction_id").alias("ids"))


@query("ml_cross_validate")
def _(spark, sf):
    """Mean area under ROC per parameter set, five folds."""
    train, _ = prepared(spark, sf)
    search = model.cross_validate(train, prepared=True)
    return model.search_results(spark, search)

"""Training, evaluation and use of fraud classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions import rules, times
from cardwatch.learning import trees
from cardwatch.learning.evaluation import evaluate_scores
from cardwatch.learning.votes import Votes
from cardwatch.operators import shape
from cardwatch.session import staged

# Input columns of the models.
CATEGORICAL = ("transaction_type", "channel", "card_type", "merchant_category", "currency")
NUMERIC = ("amount", "previous_balance", "hour", "day_of_week", "amount_zscore", "velocity_score",
           "time_since_last_tx")
# Lowest probability of each level.
PROBABILITY_LEVELS = (("CRITICAL", 0.9), ("HIGH", 0.7), ("MEDIUM", 0.5))
SEED = 42
# Iterations that the search over parameters compares.
ITERATIONS = (50, 100)
ROWS_PER_TASK = 1_000_000
# Rows a core up to which all trees grow side by side, trees that do so beyond, distance of their seeds.
ROWS_AT_ONCE, TREES_PER_FIT, SEED_STEP = 250_000, 20, 1_000_003


def prepare(df: DataFrame, numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Time features, numeric flags, filled gaps and the label; absent numeric columns become 0."""
    timed = df.withColumns({"hour": times.hour_of_day(), "day_of_week": times.day_of_week(),
                            "is_international_num": F.coalesce(F.col("is_international").cast("int"), F.lit(0))})
    numbers = {c: F.nanvl((F.col(c) if c in timed.columns else F.lit(0.0)).cast("double"), F.lit(0.0)) for c in numeric}
    filled = shape.fill_missing(timed.withColumns(numbers), numeric, categorical)
    return filled.withColumn("label", F.col("is_fraud").cast("double"))


def feature_stages(one_hot: bool = True, numeric: Sequence[str] = NUMERIC,
                   categorical: Sequence[str] = CATEGORICAL) -> list[Estimator]:
    """Index, encode (optional), assemble and standardise."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in categorical]
    numbers = VectorAssembler(inputCols=[*numeric, "is_international_num"], outputCol="numeric_features",
                              handleInvalid="keep")
    scaler = StandardScaler(inputCol="numeric_features", outputCol="scaled_features", withStd=True, withMean=True)
    suffix, encoders = "index", []
    if one_hot:
        suffix = "vec"
        encoders = [OneHotEncoder(inputCols=[f"{c}_index" for c in categorical],
                                  outputCols=[f"{c}_vec" for c in categorical])]
    last = VectorAssembler(inputCols=[*(f"{c}_{suffix}" for c in categorical), "scaled_features"],
                           outputCol="features", handleInvalid="keep")
    return [*indexers, *encoders, numbers, scaler, last]


def logistic_regression(max_iter: int = 100, reg: float = 0.01, elastic_net: float = 0.0) -> Estimator:
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg,
                              elasticNetParam=elastic_net)


def random_forest(trees: int = 100, depth: int = 10, min_rows: int = 1, subset: str = "auto") -> Estimator:
    """The same trees as without ``cacheNodeIds``; a row's place in each tree is kept, not found from the root on each level.

    Places follow from those of the level before, a few steps back to the rows, so they are not written to checkpoints.
    """
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth,
                                  minInstancesPerNode=min_rows, featureSubsetStrategy=subset, seed=SEED, cacheNodeIds=True,
                                  checkpointInterval=-1)


def boosted_trees(iterations: int = 50, depth: int = 5) -> Estimator:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth, seed=SEED)


def split(df: DataFrame, test_share: float = 0.2, key: str = "transaction_id") -> tuple[DataFrame, DataFrame]:
    """Repeatable split by a hash of the id: the same row is always on the same side, in every class."""
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.col(key)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000
    held_out = bucket < int(test_share * 10_000)
    return df.where(~held_out), df.where(held_out)


def train(df: DataFrame, classifier: Estimator, one_hot: bool = True, prepared: bool = False) -> PipelineModel:
    """Fits features and classifier on the labelled rows."""
    return train_all(df, {"model": classifier}, one_hot, prepared)["model"]


def train_all(df: DataFrame, classifiers: Mapping[str, Estimator], one_hot: bool = True, prepared: bool = False,
              from_counts: bool = False) -> dict[str, PipelineModel]:
    """Fits the features once on the labelled rows, and every classifier on the rows these give.

    A classifier passes over its rows many times, each as slow as its fullest task, so their features are written once
    and dealt out evenly, and each task keeps its part on disk. Within a task like rows follow each other: they meet the
    same nodes of the trees. Tasks and their order follow from the rows, as a forest draws its samples along them.
    With ``from_counts``, trees over many rows with one-hot columns are those of ``trees``.
    """
    data = (df if prepared else prepare(df)).where(F.col("label").isNotNull())
    features = Pipeline(stages=feature_stages(one_hot)).fit(data)
    order = [F.xxhash64(*CATEGORICAL).alias("_like"), F.col(NUMERIC[0]).alias("_number"), F.xxhash64(*data.columns).alias("_place")]
    rows = staged(df.sparkSession, features.transform(data).select("features", "label", *order), "training")
    count = rows.count()
    even = (rows.repartition(parts(df.sparkSession, count), "_place")
            .sortWithinPartitions("_like", "_number", "_place").select("features", "label").persist(StorageLevel.DISK_ONLY))
    try:
        counted = {}
        if from_counts and one_hot and _many(even, count):
            sizes = [n - 1 for stage in features.stages if isinstance(stage, OneHotEncoderModel) for n in stage.categorySizes]
            counted = trees.grow_all(even, count, {n: c for n, c in classifiers.items() if trees.can_grow(c)}, sizes, _shares)
        return {name: PipelineModel([*features.stages, *([counted[name]] if name in counted else _fitted(classifier, even, count))])
                for name, classifier in classifiers.items()}
    finally:
        even.unpersist()


def _many(rows: DataFrame, count: int) -> bool:
    return count > ROWS_AT_ONCE * rows.sparkSession.sparkContext.defaultParallelism


def _fitted(classifier: Estimator, rows: DataFrame, count: int) -> list[Transformer]:
    """The fitted classifier; over many rows a forest grows in groups of trees, whose votes the last stage adds up.

    A row's samples and places are kept for all trees that grow side by side, 1.9 KB a row for 100 of them and 0.6 KB
    for 20. As every tree draws its own sample, groups of own seeds make one forest.
    """
    shares = _shares(classifier) if isinstance(classifier, RandomForestClassifier) and _many(rows, count) else []
    if len(shares) < 2:
        return [classifier.fit(rows)]
    votes = [f"_votes_{i}" for i in range(len(shares))]
    grown = [classifier.fit(rows, {
        classifier.numTrees: number, classifier.seed: seed,
        classifier.rawPredictionCol: column, classifier.probabilityCol: "", classifier.predictionCol: ""})
        for (number, seed), column in zip(shares, votes)]
    return [*grown, Votes(inputCols=votes)]


def _shares(forest: RandomForestClassifier) -> list[tuple[int, int]]:
    """Trees and seed of each group that a forest over many rows is made of."""
    number, seed = forest.getNumTrees(), forest.getSeed()
    groups = -(-number // TREES_PER_FIT)
    return [(number * (i + 1) // groups - number * i // groups, seed + SEED_STEP * i) for i in range(groups)]


def parts(spark: SparkSession, rows: int) -> int:
    """Tasks that training rows are dealt out to: a multiple of the cores, with at most ``ROWS_PER_TASK`` rows each."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(2, -(-rows // (cores * ROWS_PER_TASK)))


def cross_validate(df: DataFrame, folds: int = 5, parallelism: int = 4,
                   prepared: bool = False) -> CrossValidatorModel:
    """Logistic regression over twelve parameter sets by area under ROC, as ``CrossValidator`` does it.

    Features depend on a fold's training rows only, so they are fitted once a fold and not once a parameter set. A
    regression that converges within the smaller number of iterations counts for both, as it would take the same steps.
    """
    lr = LogisticRegression(featuresCol="features", labelCol="label")
    grid = (ParamGridBuilder().addGrid(lr.maxIter, list(ITERATIONS)).addGrid(lr.regParam, [0.01, 0.1])
            .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build())
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    data = (df if prepared else prepare(df)).where(F.col("label").isNotNull())
    drawn = data.withColumn("_fold", F.floor(F.rand(SEED) * folds))
    found = []
    with ThreadPool(parallelism) as pool:
        for fold in range(folds):
            training, held_out = drawn.where(F.col("_fold") != fold), drawn.where(F.col("_fold") == fold)
            features = Pipeline(stages=feature_stages()).fit(training)
            narrow = [features.transform(part).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
                      for part in (training, held_out)]
            try:
                found.append(_areas(lr, grid, judge, *narrow, pool))
            finally:
                for part in narrow:
                    part.unpersist()
    means = [sum(areas) / folds for areas in zip(*found)]
    winner = grid[max(range(len(grid)), key=lambda i: means[i])]
    search = CrossValidatorModel(Pipeline(stages=[*feature_stages(), lr]).fit(data, winner), means)
    for param, value in ((search.estimatorParamMaps, grid), (search.evaluator, judge), (search.numFolds, folds)):
        search.set(param, value)
    return search


def _areas(lr: LogisticRegression, grid: Sequence[dict], judge: BinaryClassificationEvaluator, training: DataFrame,
           held_out: DataFrame, pool: ThreadPool) -> list[float]:
    """Area on the held-out rows for each parameter set, in the order of the grid."""
    few, many = ITERATIONS

    def of(penalty: tuple[float, float]) -> dict[tuple[int, float, float], float]:
        def fitted(iterations: int):
            return lr.fit(training, {lr.maxIter: iterations, lr.regParam: penalty[0], lr.elasticNetParam: penalty[1]})
        longest = fitted(many)
        area = {many: judge.evaluate(longest.transform(held_out))}
        converged = longest.summary.totalIterations < few
        area[few] = area[many] if converged else judge.evaluate(fitted(few).transform(held_out))
        return {(n, *penalty): value for n, value in area.items()}

    penalties = sorted({(p[lr.regParam], p[lr.elasticNetParam]) for p in grid})
    areas = {key: value for part in pool.map(inheritable_thread_target(training.sparkSession)(of), penalties) for key, value in part.items()}
    return [areas[p[lr.maxIter], p[lr.regParam], p[lr.elasticNetParam]] for p in grid]


def search_results(spark: SparkSession, search: CrossValidatorModel) -> DataFrame:
    """One row per parameter set (twelve), best first."""
    rows = [(*(int(v) if p.name == "maxIter" else float(v) for p, v in
               sorted(params.items(), key=lambda e: e[0].name)), float(auc))
            for params, auc in zip(search.getEstimatorParamMaps(), search.avgMetrics)]
    return spark.createDataFrame(rows, "elastic_net double, max_iter int, reg double, auc_roc double").orderBy(
        F.desc("auc_roc"), "max_iter", "reg", "elastic_net")


def scores(predictions: DataFrame, name: str = "model") -> DataFrame:
    """What evaluation needs of a model's output: (model, score, prediction, label)."""
    return predictions.select(F.lit(name).alias("model"), vector_to_array("probability")[1].alias("score"), "prediction", "label")


def evaluate(predictions: DataFrame, name: str = "model") -> DataFrame:
    """One row of metrics: areas, accuracy, precision, recall, F1 and the confusion counts."""
    return evaluate_scores(scores(predictions, name))


def best(metrics: Sequence[DataFrame]) -> DataFrame:
    """The row with the highest F1."""
    return shape.union_batches(metrics).orderBy(F.desc_nulls_last("f1"), "model").limit(1)


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5, prepared: bool = False) -> DataFrame:
    """Probability of fraud, decision and level; works on a stream too."""
    probability = vector_to_array("probability")[1]
    level = F
    for name, lowest in PROBABILITY_LEVELS:
        level = level.when(F.col("fraud_probability") >= lowest, name)
    scored = model.transform(df if prepared else prepare(df)).withColumn("fraud_probability", probability)
    return scored.select("transaction_id", "customer_id", "amount", "fraud_probability",
                         (F.col("fraud_probability") >= threshold).alias("is_fraud_predicted"),
                         level.otherwise(rules.LOWEST_LEVEL).alias("risk_level"))


def importance(spark: SparkSession, model: PipelineModel, transformed: DataFrame) -> DataFrame:
    """Feature names and weights of a tree model, most important first."""
    groups = transformed.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in groups.values() for a in group}
    # each tree that splits weighs the same, also where groups of them were grown
    groups = [stage for stage in model.stages if hasattr(stage, "featureImportances")]
    sums = sum(group.featureImportances.toArray() * sum(tree.depth > 0 for tree in group.trees) for group in groups)
    weights = sums / (sums.sum() or 1.0)
    rows = [(names.get(i, str(i)), float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)

"""Classifiers on a separable set."""

import random
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from cardwatch.learning import evaluation, model, split, trees
from cardwatch.operators import generate
from cardwatch.plans import QUERIES, model_queries


@pytest.fixture(scope="module")
def data(spark):
    rows = generate.transactions(spark.range(4000), fraud_rate=0.2).withColumn(
        "is_fraud", F.when(F.pmod(F.hash("transaction_id"), F.lit(50)) != 0, F.col("is_fraud")))
    return model.prepare(rows).cache()


def test_split_is_repeatable_and_complete(data):
    train, test = model.split(data)
    assert train.count() + test.count() == 4000 and 700 < test.count() < 900
    assert train.join(test, "transaction_id", "left_semi").isEmpty()
    again = model.split(data.repartition(7))[1]
    assert again.select("transaction_id").exceptAll(test.select("transaction_id")).isEmpty()


def test_train_evaluate_save_and_importance(spark, data, tmp_path):
    train, test = model.split(data)
    metrics = []
    for name, classifier in (("forest", model.random_forest(10, 5)), ("boosted", model.boosted_trees(3, 3)),
                             ("regression", model.logistic_regression(20))):
        fitted = model.train(train, classifier, one_hot=name == "regression", prepared=True)
        metrics.append(model.evaluate(fitted.transform(test), name))
        if name == "forest":
            forest = fitted
    rows = {r["model"]: r for m in metrics for r in m.collect()}
    labelled = test.where("label IS NOT NULL").count()
    for row in rows.values():
        assert row.auc_roc > 0.8
        assert row.true_positives + row.false_positives + row.false_negatives + row.true_negatives == labelled
    top = model.best(metrics).first()
    assert top.f1 == max(r.f1 for r in rows.values())
    model.save(forest, str(tmp_path / "m"))
    predicted = model.predict(forest, test, prepared=True)
    again = model.predict(model.load(str(tmp_path / "m")), test, prepared=True)
    assert predicted.exceptAll(again).isEmpty() and predicted.count() == test.count()
    levels = predicted.groupBy("risk_level").agg(F.min("fraud_probability").alias("p")).collect()
    assert all(r.p >= dict(model.PROBABILITY_LEVELS).get(r.risk_level, 0) for r in levels)
    weights = model.importance(spark, forest, forest.transform(test)).collect()
    assert abs(sum(r.importance for r in weights) - 1) < 1e-6 and "merchant_category_index" in [r.feature for r in weights]
    model.save_metrics(metrics[0], str(tmp_path / "metrics"))
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 1


def test_classifiers_share_features_and_even_tasks_and_a_forest_keeps_its_trees(spark, data, monkeypatch):
    from pyspark.ml import Pipeline
    fits, whole = [], model.StringIndexer._fit
    monkeypatch.setattr(model.StringIndexer, "_fit", lambda self, df: fits.append(1) or whole(self, df))
    forest, seen = model.random_forest(10, 5), []
    monkeypatch.setattr(type(forest), "_fit", lambda self, df, fit=type(forest)._fit: seen.append(df) or fit(self, df))
    uneven = data.coalesce(1)
    fitted = model.train_all(uneven, {"forest": forest, "regression": model.logistic_regression(20)}, prepared=True)
    assert len(fits) == len(model.CATEGORICAL)
    sizes = seen[0].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 2 * spark.sparkContext.defaultParallelism and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert sum(sizes) == data.where("label IS NOT NULL").count()
    # the same trees when places in them are not kept, and again from rows that lie otherwise
    assert forest.getCacheNodeIds()
    plain = forest.copy({forest.cacheNodeIds: False}).fit(seen[0])
    assert plain.toDebugString.split("\n", 1)[1] == fitted["forest"].stages[-1].toDebugString.split("\n", 1)[1]
    again = model.train(data.repartition(7), forest, prepared=True).stages[-1]

    def rounded(one):  # the scale of a feature is a sum of doubles over tasks
        return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.6g}", one.toDebugString.split("\n", 1)[1])
    assert rounded(again) == rounded(plain)
    features = Pipeline(stages=model.feature_stages()).fit(data.where("label IS NOT NULL")).transform(data)
    assert features.schema["features"].metadata["ml_attr"] == seen[0].schema["features"].metadata["ml_attr"]
    assert fitted["regression"].transform(data).where("probability IS NOT NULL").count() == 4000


def test_a_large_forest_grows_in_groups_of_trees_over_like_rows(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(model, "TREES_PER_FIT", 4)
    monkeypatch.setattr(model, "ROWS_AT_ONCE", 0)
    whole, seen = model.random_forest(10, 5), []
    monkeypatch.setattr(type(whole), "_fit", lambda self, df, fit=type(whole)._fit: seen.append((self.getNumTrees(), df)) or fit(self, df))
    train, test = model.split(data)
    fitted = model.train(train, whole, prepared=True)
    assert [n for n, _ in seen] == [3, 3, 4]
    groups = fitted.stages[-4:-1]
    trees = [tree for group in groups for tree in group.trees]
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in trees}) == 10
    # votes are those of the ten trees, one by one
    given, own = fitted.transform(test), fitted.transform(test).select("transaction_id", "features")
    expected, mean = {r.transaction_id: [0.0, 0.0] for r in own.select("transaction_id").collect()}, 0
    for tree in trees:
        for r in tree.setProbabilityCol("probability").transform(own).select("transaction_id", "probability").collect():
            expected[r.transaction_id] = [a + b for a, b in zip(expected[r.transaction_id], r.probability)]
        mean += tree.featureImportances.toArray() / len(trees)
    for r in given.select("transaction_id", "rawPrediction", "probability", "prediction").collect():
        votes = expected[r.transaction_id]
        assert max(abs(a - b) for a, b in zip(r.rawPrediction, votes)) < 1e-9
        assert max(abs(a - b / 10) for a, b in zip(r.probability, votes)) < 1e-9
        assert r.prediction == float(r.probability[1] > r.probability[0])
    assert not [c for c in given.columns if c.startswith("_")]
    weights = [r.importance for r in model.importance(spark, fitted, given).collect()]
    assert max(abs(a - b) for a, b in zip(weights, sorted(mean, reverse=True))) < 1e-9
    model.save(fitted, str(tmp_path / "m"))
    again = model.predict(model.load(str(tmp_path / "m")), test, prepared=True)
    assert model.predict(fitted, test, prepared=True).exceptAll(again).isEmpty() and again.count() == test.count()
    # in a task, rows of equal categories follow each other, by amount
    width = sum(len(s.labels) for s in fitted.stages if hasattr(s, "labels"))
    for rows in seen[0][1].rdd.glom().map(lambda part: [(tuple(r.features.toArray()[:width]), r.features[width]) for r in part]).collect():
        starts = [i for i, (kind, _) in enumerate(rows) if i == 0 or rows[i - 1][0] != kind]
        assert len(starts) == len({kind for kind, _ in rows})
        assert all(a[0] != b[0] or a[1] <= b[1] for a, b in zip(rows, rows[1:]))


def blurred(data):
    """Labels that no tree gets all right."""
    wrong = F.pmod(F.hash("transaction_id", "amount"), F.lit(11)) == 0
    return data.where("label IS NOT NULL").withColumn("label", F.when(wrong, 1 - F.col("label")).otherwise(F.col("label")))


def test_trees_from_counts_are_those_of_spark(data, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    features = Pipeline(stages=model.feature_stages()).fit(blurred(data))
    sizes = [n - 1 for stage in features.stages if isinstance(stage, model.OneHotEncoderModel) for n in stage.categorySizes]
    rows = features.transform(blurred(data)).select("transaction_id", "features", "label").repartition(3, "transaction_id").cache()
    monkeypatch.setattr(trees, "TREES_PER_STATE", 2)
    monkeypatch.setattr(trees, "BLOCK", 500)
    classifiers = {"tree": RandomForestClassifier(numTrees=1, maxDepth=5, bootstrap=False, seed=7, minInstancesPerNode=3),
                   "boosted": GBTClassifier(maxIter=5, maxDepth=3, seed=7, maxBins=20)}
    for many in (False, True):
        if many:  # more rows than bounds are taken from
            rows = rows.unionByName(rows).unionByName(rows).repartition(3, "transaction_id").sortWithinPartitions("transaction_id").cache()
        grown = trees.grow_all(rows, rows.count(), classifiers, sizes, model._shares)
        for name, classifier in classifiers.items():
            own, theirs = grown[name], classifier.fit(rows)
            assert (own.getNumTrees, own.totalNumNodes, own.treeWeights) == (theirs.getNumTrees, theirs.totalNumNodes, theirs.treeWeights)
            assert own.numFeatures == theirs.numFeatures and own.extractParamMap().keys() == theirs.extractParamMap().keys()
            scored = [{r.transaction_id: r.probability[1] for r in m.transform(rows).collect()} for m in (own, theirs)]
            assert max(abs(scored[0][k] - scored[1][k]) for k in scored[1]) < 1e-9 and len(set(scored[0].values())) > 5


def test_many_rows_are_counted_for_a_forest_and_boosted_trees(data, monkeypatch, tmp_path):
    from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
    train, test = model.split(blurred(data))
    classifiers = {"forest": model.random_forest(30, 6), "boosted": model.boosted_trees(4, 3), "regression": model.logistic_regression(20)}
    plain = model.train_all(train, classifiers, prepared=True, from_counts=True)
    before = {r.model: r for name, m in plain.items() for r in model.evaluate(m.transform(test), name).collect()}
    monkeypatch.setattr(model, "ROWS_AT_ONCE", 0)
    fits = []
    for kind in (RandomForestClassifier, GBTClassifier):
        monkeypatch.setattr(kind, "_fit", lambda self, df: fits.append(type(self)))
    fitted = model.train_all(train, classifiers, prepared=True, from_counts=True)
    assert not fits and list(fitted) == list(classifiers)
    after = {r.model: r for name, m in fitted.items() for r in model.evaluate(m.transform(test), name).collect()}
    assert all(abs(after[n].auc_roc - before[n].auc_roc) < (0.05 if n == "forest" else 1e-9) for n in classifiers)
    forest, rows = fitted["forest"].stages[-1], train.count()
    assert forest.getNumTrees == 30 and len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) == 30
    assert forest.transform(fitted["forest"].transform(test).select("features")).where("probability IS NOT NULL").count() == test.count()
    # every tree draws about as many rows as there are, each its own
    drawn = [t._call_java("rootNode").impurityStats().count() for t in forest.trees]
    assert all(abs(n - rows) < 6 * rows ** 0.5 for n in drawn) and len(set(drawn)) > 10
    counted = [t._call_java("rootNode").impurityStats().count() for t in fitted["boosted"].stages[-1].trees]
    assert counted == [rows] * 4
    # the same trees again, and from a file
    again = model.train_all(train, {"forest": classifiers["forest"]}, prepared=True, from_counts=True)["forest"].stages[-1]
    assert again.toDebugString.split("\n", 1)[1] == forest.toDebugString.split("\n", 1)[1]
    forest.write().save(str(tmp_path / "m"))
    loaded = RandomForestClassificationModel.load(str(tmp_path / "m"))
    assert loaded.toDebugString.split("\n", 1)[1] == forest.toDebugString.split("\n", 1)[1]


def test_training_rows_are_dealt_out_by_cores_and_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert model.parts(spark, 0) == model.parts(spark, 2 * cores * model.ROWS_PER_TASK) == 2 * cores
    assert model.parts(spark, 2 * cores * model.ROWS_PER_TASK + 1) == 3 * cores


def test_the_classifiers_compared_fit_their_features_once(spark, monkeypatch):
    fits, whole = [], model.StringIndexer._fit
    monkeypatch.setattr(model.StringIndexer, "_fit", lambda self, df: fits.append(1) or whole(self, df))
    monkeypatch.setattr(model_queries, "CLASSIFIERS", {
        "logistic_regression": lambda: model.logistic_regression(5), "random_forest": lambda: model.random_forest(3, 3),
        "boosted_trees": lambda: model.boosted_trees(2, 2)})
    rows = QUERIES["ml_evaluate"](spark, SMALL).collect()
    assert sorted(r.model for r in rows) == ["boosted_trees", "logistic_regression", "random_forest"]
    assert len(fits) == len(model.CATEGORICAL)


def test_search_fits_features_once_a_fold_and_agrees_with_the_plain_one(data, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator
    fits, whole = [], model.StringIndexer._fit
    monkeypatch.setattr(model.StringIndexer, "_fit", lambda self, df: fits.append(1) or whole(self, df))
    search = model.cross_validate(data, folds=2, prepared=True)
    assert len(fits) == len(model.CATEGORICAL) * 3  # two folds and the final model
    assert len(search.avgMetrics) == len(search.getEstimatorParamMaps()) == 12
    lr = LogisticRegression(featuresCol="features", labelCol="label")
    for i in (0, 5, 8):
        own = {p.name: v for p, v in search.getEstimatorParamMaps()[i].items()}
        plain = CrossValidator(estimator=Pipeline(stages=[*model.feature_stages(), lr]), numFolds=2, seed=model.SEED,
                               estimatorParamMaps=[{lr.getParam(n): v for n, v in own.items()}],
                               evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC"))
        assert abs(plain.fit(data.where("label IS NOT NULL")).avgMetrics[0] - search.avgMetrics[i]) < 1e-9
    assert search.transform(data).where("probability IS NOT NULL").count() == 4000


def test_prepare_fills_and_keeps_null_labels_out_of_training(make):
    df = model.prepare(make({"currency": None, "is_fraud": None}))
    row = df.first()
    assert (row.currency, row.label, row.amount_zscore, row.is_international_num) == ("UNKNOWN", None, 0.0, 0)

@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_exact_share_of_every_class(spark, share):
    rows = [(f"T{i}", [None, 0, 1, 1][i % 4] if i < 200 else 7) for i in range(205)] + [("T3", 1)] * 9 + [(None, 0)] * 3
    df = spark.createDataFrame(rows, "transaction_id string, is_fraud int")
    train, test = split.stratified(df.repartition(4), share)
    assert train.unionByName(test).exceptAll(df).isEmpty() and df.exceptAll(train.unionByName(test)).isEmpty()
    n, taken = (dict(x.groupBy("is_fraud").count().collect()) for x in (df, test))
    assert {k: taken.get(k, 0) for k in n} == {k: int(v * share + 0.5) for k, v in n.items()}
    again = split.stratified(df.repartition(2), share)[1]
    assert again.exceptAll(test).isEmpty() and test.exceptAll(again).isEmpty()


def test_split_of_nothing(spark):
    train, test = split.stratified(spark.createDataFrame([], "transaction_id string, is_fraud int"))
    assert train.isEmpty() and test.isEmpty()


@pytest.mark.parametrize("blocks", [1, 7, 1024])
def test_areas_equal_all_pairs_and_all_thresholds(spark, blocks):
    rng = random.Random(2)
    rows = [(m, rng.randrange(12) / (7 if m == "a" else 1) - (3 if m == "c" else 0), float(rng.random() < 0.5), float(rng.random() < 0.4))
            for m in "abc" for _ in range(120)]
    rows += [("one", 0.5, 1.0, 1.0), ("one", 0.5, 0.0, 1.0), ("a", None, 1.0, 1.0), ("a", float("nan"), 1.0, 1.0), ("a", 0.5, 1.0, None)]
    got = {r.model: r for r in evaluation.evaluate_scores(
        spark.createDataFrame(rows, "model string, score double, prediction double, label double"), blocks).collect()}
    assert got["one"].auc_roc is None and got["one"].auc_pr == 1.0
    for m in "abc":
        own = [(s, p, l) for k, s, p, l in rows if k == m and s is not None and s == s and l is not None]
        pos, neg = [s for s, _, l in own if l], [s for s, _, l in own if not l]
        roc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
        points = [(sum(s >= t for s in pos), sum(s >= t for s in pos + neg)) for t in sorted({s for s, _, _ in own}, reverse=True)]
        points = [(0, points[0][0] / points[0][1])] + [(tp / len(pos), tp / n) for tp, n in points]
        pr = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        assert abs(got[m].auc_roc - roc) < 1e-12 and abs(got[m].auc_pr - pr) < 1e-12
        assert got[m].true_positives == sum(p == 1 and l == 1 for _, p, l in own)
        assert got[m].false_negatives == sum(p != 1 and l == 1 for _, p, l in own)

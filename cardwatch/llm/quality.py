"""Quality classifier: a support vector machine over n-gram indicators scaled by their class log-count ratios.

Features are the distinct words, word pairs and runs of ``LETTERS`` bytes of the whole text, hashed to ``BUCKETS``.
With p and q the smoothed counts of documents of class 1 and 0 that have a feature, its scale is
log((p / |p|) / (q / |q|)). The linear model is fitted on the scaled indicators, each document brought to length 1, by
dual coordinate descent on the hinge loss, and pulled towards the plain log-count model by ``blend``. A logistic curve
fitted on a fifth of the training rows, which the model has not seen, turns margins into scores from 0 to 1.

It is fitted on at most ``max_rows`` labelled documents, the first by a seeded hash of the key, one row per key, and of
these on the first that have ``max_features`` features together: these bounds are parameters, and a document is scored
alike whatever the size of the corpus. One task fits the model; what the driver holds is the array of ``BUCKETS``
coefficients.

Defined cases: null and empty texts have no feature and get the score of the bias alone; rows with a null label or key
are not learned from; several labels of a key count as their mean, 1 from one half up; of several rows of a key the text
of least hash is learned from; if only one class is labelled,
every score is that class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.work import staged

BUCKETS = 1 << 18
LETTERS = 4


@dataclass(frozen=True)
class Model:
    """score = 1 / (1 + exp(-(slope * margin + offset))), margin = sum of coefficients / length of the scaled vector."""

    coefficient: np.ndarray
    scale: np.ndarray
    bias: float
    slope: float
    offset: float


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) once each, in order, over the whole of every text."""
    words = W.split(texts)
    owners, values = [words.text], [words.hash[0]]
    at, pairs = words.grams(2)
    owners.append(words.text[at])
    values.append(pairs)
    n = len(words.data) - LETTERS + 1
    if n > 0:
        total = np.zeros(n, np.uint64)
        for j in range(LETTERS):
            total = (total << np.uint64(8)) | words.data[j:j + n].astype(np.uint64)
        offsets = np.cumsum(np.asarray(pc.binary_length(W.binary(texts))))
        owner = np.searchsorted(offsets, np.arange(n), "right")
        inside = owner == np.searchsorted(offsets, np.arange(n) + LETTERS - 1, "right")
        owners.append(owner[inside])
        values.append(W.mixed(total[inside] + np.uint64(1)))
    key = np.unique(np.concatenate(owners).astype(np.int64) * BUCKETS
                    + (np.concatenate(values) % np.uint64(BUCKETS)).astype(np.int64))
    return key // BUCKETS, key % BUCKETS


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in W.slices(whole, "_text"):
            owner, value = features(batch.column("_text"))
            yield pa.RecordBatch.from_arrays([batch.column("_order"), batch.column("_label"),
                                              W.lists(owner, value.astype(np.int32), batch.num_rows, pa.int32())],
                                             ["_order", "_label", "_features"])


def descend(rows: list[np.ndarray], scale: np.ndarray, label: np.ndarray, cost: float, epochs: int,
            seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + cost * hinge loss, one dual variable at a time."""
    rng, weight, bias = np.random.default_rng(seed), np.zeros(len(scale)), 0.0
    values = [scale[r] / (np.sqrt(np.sum(scale[r] ** 2)) or 1.0) for r in rows]
    square = np.array([np.dot(v, v) + 1.0 for v in values])
    dual = np.zeros(len(rows))
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            slope = label[i] * (np.dot(weight[rows[i]], values[i]) + bias) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * label[i]
                weight[rows[i]] += step * values[i]
                bias += step
                largest = max(largest, abs(new - dual[i]))
                dual[i] = new
        if largest < 1e-3 * cost:
            break
    return weight, bias


def _margins(model_coefficient: np.ndarray, scale: np.ndarray, bias: float, owner: np.ndarray, value: np.ndarray,
             n: int) -> np.ndarray:
    length = np.sqrt(np.bincount(owner, scale[value] ** 2, n))
    return np.bincount(owner, model_coefficient[value], n) / np.where(length > 0, length, 1.0) + bias


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to labels, by Newton steps on smoothed labels."""
    ones, zeros = float(np.sum(label > 0)), float(np.sum(label < 0))
    aim = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.stack([margin, np.ones_like(margin)])
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(found @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (aim - p))
        found = found + np.clip(step, -5, 5)
        if np.max(np.abs(step)) < 1e-8:
            break
    return float(max(found[0], 1e-3)), float(found[1])


def train(rows: list[np.ndarray], label: np.ndarray, cost: float = 1.0, blend: float = 0.25, epochs: int = 20,
          seed: int = 0) -> Model:
    """label: 1 or -1 per row of feature indices."""
    if len(set(label.tolist())) < 2:
        only = float(label[0]) if len(label) else 1.0
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, 20.0 * only)
    aside = np.arange(len(rows)) % 5 == 4
    if len(set(label[aside].tolist())) < 2 or len(set(label[~aside].tolist())) < 2:
        aside = np.zeros(len(rows), bool)
    counts = {}
    for kind in (1, -1):
        used = [r for r, y, a in zip(rows, label, aside) if y == kind and not a]
        counts[kind] = 1.0 + np.bincount(np.concatenate(used), minlength=BUCKETS)
    scale = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    kept = np.flatnonzero(~aside)
    weight, bias = descend([rows[i] for i in kept], scale, label[kept], cost, epochs, seed)
    seen = (counts[1] > 1) | (counts[-1] > 1)
    mean = np.sum(np.abs(weight[seen])) / max(int(seen.sum()), 1)
    coefficient = ((1 - blend) * mean + blend * weight) * scale
    test = np.flatnonzero(aside) if aside.any() else kept
    sizes = [len(rows[i]) for i in test]
    margin = _margins(coefficient, scale, blend * bias, np.repeat(np.arange(len(test)), sizes),
                      np.concatenate([rows[i] for i in test]), len(test))
    slope, offset = logistic(margin, label[test])
    return Model(coefficient, scale, blend * bias, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        usable: Column | None = None, max_rows: int = 16_000, max_features: int = 100_000_000, seed: int = 0,
        **settings: float) -> Model:
    """The model of labelled documents; ``usable`` says which labelled keys may be learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.where(usable) if usable is not None else known
    chosen = (known.groupBy(key).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
              .withColumn("_order", F.xxhash64(F.lit(seed), F.col(key).cast("string"))).orderBy("_order", key)
              .limit(max_rows).withColumnRenamed(key, "_key"))
    # at most max_rows short rows
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    sample = (sample.groupBy("_key", "_order", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
              .select("_order", "_label", "_text"))
    sample = staged(sample.mapInArrow(_featured, "_order bigint, _label int, _features array<int>"), "quality-sample")
    sizes = sample.groupBy("_order").agg(F.sum(F.size("_features")).alias("_n"))
    upto = sizes.select("_order", F.expr("sum(_n) over (order by _order)").alias("_upto")).where(F.col("_upto") <= max_features)
    sample = sample.join(F.broadcast(upto), "_order").select("_order", "_label", "_features")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            order, sign = np.asarray(batch.column("_order")), np.asarray(batch.column("_label"))
            column = batch.column("_features")
            for i in range(batch.num_rows):
                row = np.asarray(column[i].values)
                if len(row):
                    found.append((int(order[i]), int(sign[i]), row.astype(np.int32)))
        found.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))
        model = train([r[2] for r in found], np.array([1 if r[1] else -1 for r in found]), seed=seed, **settings)
        yield pa.RecordBatch.from_pydict({
            "coefficient": [model.coefficient.astype(np.float32).tobytes()],
            "scale": [model.scale.astype(np.float32).tobytes()], "bias": [model.bias], "slope": [model.slope],
            "offset": [model.offset]})

    row = sample.repartition(1).mapInArrow(
        fitted, "coefficient binary, scale binary, bias double, slope double, offset double").first()
    if row is None:
        return train([], np.zeros(0))
    return Model(np.frombuffer(row.coefficient, np.float32).astype(float), np.frombuffer(row.scale, np.float32).astype(float),
                 row.bias, row.slope, row.offset)


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns with the score of the whole text."""
    docs = docs.drop(score)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    parts = (model.coefficient.astype(np.float32), model.scale.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficient, scale = (p.astype(float) for p in parts)
        for whole in batches:
            for batch in W.slices(whole, text):
                owner, value = features(batch.column(text))
                margin = _margins(coefficient, scale, model.bias, owner, value, batch.num_rows)
                found = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -700, 700)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, score])

    return docs.mapInArrow(run, schema)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the key as text leaves no rest by ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0

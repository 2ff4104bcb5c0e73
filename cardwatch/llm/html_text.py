"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded down the tree.

Every block element of a page has features of its subtree (text, density, links, punctuation), its attribute and tag
words, depth and siblings. Boosted trees give each element the chance of being main text. Decoding picks the most
probable choice for the whole page under the rule that main text starts at some elements and, once cut off below them,
does not come back, so an ancestor and a descendant never contradict each other; inline elements go with their block.

The trees are trained here, on at most ``max_pages`` pages, the first by a hash of their id: pages that mark their main
text up (article, main) serve as labels. Each of them is used four times: as it is; without its tag and attribute
words, so that the trees also judge pages without telling names; and twice with strange blocks set between its blocks
that hold its own sentences under names such as comments or promo, so that the trees heed names inside the main text. The bound is a parameter; all pages are extracted
alike, whole. Training is Spark ML's; the trees, a few hundred numbers, go to the tasks.

Defined cases: null and empty pages have an empty text; a page without any element that looks like main text, too;
where no page of the sample is marked up, an element counts as main text unless its names speak against it; repeated
rows are extracted each on its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.dom import HINTS, N_FEATURES, Page, varied
from cardwatch.llm.work import discard, folder, staged

FLOOR = 1e-4


@dataclass(frozen=True)
class Trees:
    """Per tree: weight, split feature (-1 at leaves), threshold, children, value."""

    trees: list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def chance(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.where(x[:, HINTS[1]] + x[:, HINTS[3]] > 0, 0.05, 0.9)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                go = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += weight * value[at]
        return np.clip(1 / (1 + np.exp(-2 * total)), FLOOR, 1 - FLOOR)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in W.slices(whole, "_html"):
            rows, labels = [], []
            for seed, source in zip(batch.column("_o").to_pylist(), batch.column("_html").to_pylist()):
                page = Page(source or "")
                if (own := page.labels()) is None:
                    continue
                found = page.features()
                rows += [*found, *([0.0 if i in HINTS else v for i, v in enumerate(r)] for r in found)]
                labels += own + own
                for k in (0, 1):
                    page = Page(varied(source, seed + k))
                    rows += page.features()
                    labels += page.labels()
            flat = np.asarray(rows, float).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(labels, float)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * N_FEATURES), pa.array(flat.ravel()))],
                ["label", "_x"])


def train(pages: DataFrame, key: str = "page_id", source: str = "html", max_pages: int = 400, rounds: int = 10,
          depth: int = 4, seed: int = 0) -> Trees:
    chosen = (pages.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.xxhash64(F.lit(seed), key).alias("_o"))
              .distinct().orderBy("_o", "_key").limit(max_pages))
    # at most max_pages ids
    sample = pages.join(F.broadcast(chosen), F.col(key) == F.col("_key")).select("_o", F.col(source).alias("_html"))
    rows = staged(sample.mapInArrow(_labelled, "label double, _x array<double>"), "dom-sample")
    if rows.select("label").distinct().limit(2).count() < 2:
        return Trees()
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.5, seed=seed).fit(
        rows.coalesce(4).select("label", array_to_vector("_x").alias("features")))
    place = folder(pages.sparkSession, "dom-trees")
    model.write().save(place)
    nodes = pages.sparkSession.read.parquet(f"{place}/data")
    nodes = nodes.select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    found = []
    for tree, weight in enumerate(model.treeWeights):
        own = [n for n in nodes if n["treeID"] == tree]
        found.append((float(weight), np.array([n["split"]["featureIndex"] if n["leftChild"] >= 0 else -1 for n in own]),
                      np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["leftChild"] >= 0 else 0.0 for n in own]),
                      np.array([n["leftChild"] for n in own]), np.array([n["rightChild"] for n in own]),
                      np.array([n["prediction"] for n in own])))
    discard(rows)
    return Trees(found)


def extracted(pages: DataFrame, trees: Trees, source: str = "html", text: str = "text") -> DataFrame:
    """All rows and columns except the page itself, with its main text."""
    columns = [c for c in pages.columns if c not in (source, text)]
    rest = pages.select(*columns, F.col(source).alias("__html"))
    schema = T.StructType([*pages.select(*columns).schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "__html"):
                found = [Page(s or "") for s in batch.column("__html").to_pylist()]
                rows = [p.features() for p in found]
                chance = trees.chance(np.asarray([r for own in rows for r in own], float).reshape(-1, N_FEATURES)).tolist()
                texts, at = [], 0
                for page, own in zip(found, rows):
                    texts.append(page.text(page.decoded(chance[at:at + len(own)])))
                    at += len(own)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], schema.names)

    return rest.mapInArrow(run, schema)

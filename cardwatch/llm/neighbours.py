"""Approximate nearest neighbours: stable projections to a few dimensions, a kd-tree over them, and verification of
projected neighbours, nearest first, until a chi-square test says that the rest cannot matter.

Largest inner product becomes smallest distance by one more coordinate, which brings every vector to the length of the
longest. Gaussian (2-stable) projections of a difference have, divided by its true squared length, a chi-square
distribution with ``dims`` degrees of freedom. A query therefore stops when the projected squared distance of what is
left exceeds its k-th verified squared distance times the ``confidence`` quantile; a true neighbour is then missed
with a chance below 1 - ``confidence``.

The upper levels of the kd-tree, fitted on at most ``sample_rows`` projected rows, cut space into cells; every row is
put into its cell, and cells with many rows (copies of one vector) into numbered blocks, so no task holds more than
about two times ``block_rows`` rows. A block builds the lower levels and visits its leaves nearest first, in rounds of
twice as many leaves each: the queries of a leaf are multiplied with its rows at once, and rows that reach a query's
k-th score are scored again one by one, so a score does not depend on its neighbours in the product. Queries first search
their own cell; with the bound found there they go on only to blocks whose box passes the same test. A block that more
than ``block_queries`` queries visit is copied, one copy per slice of them. The driver holds the sample and the boxes,
at most about 2^17; block_rows grows with the table to keep that bound.

Vectors of several lengths are searched each among those of its own length: a length has its own cells, and only lengths
with more than ``block_rows`` rows are cut by the upper tree.

Defined cases: vectors that are null, zero, hold null or non-finite numbers, and rows without an id, take no part; a
query's own id is no candidate; equal scores are ranked by id; with fewer than k candidates of its length all are
returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.work import staged

LEAF = 64
MOST_BLOCKS = 1 << 16
QUERY_ROWS = 256   # queries of a block searched together
ROUTED_ROWS = 32   # queries held against all boxes at once: 2^17 boxes are 34 MB
MOST_LEAVES = 32   # leaves a query visits in one round
EXACT_PAIRS = 1 << 14


def chi_square(probability: float, freedom: int) -> float:
    """Quantile by the cube-root normal approximation, good to about a hundredth here."""
    part = 2 / (9 * freedom)
    return freedom * (1 - part + NormalDist().inv_cdf(probability) * part ** 0.5) ** 3


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, dict[int, tuple[int, float]]]:
    """(_id, _v double array), and for each length the number of rows and the largest squared length."""
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.where(F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("_v", lambda x: x != 0))
    square = F.aggregate("_v", F.lit(0.0), lambda total, x: total + x * x)
    sizes = rows.groupBy(F.size("_v").alias("_size")).agg(F.count("*").alias("_n"), F.max(square).alias("_longest"))
    # one row per length of vectors
    return rows, {r["_size"]: (r["_n"], r["_longest"]) for r in sizes.orderBy("_size").collect()}


def by_size(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, their vectors) of a column of vectors."""
    sizes, flat = np.asarray(pc.list_value_length(column)).astype(np.int64), np.asarray(column.flatten())
    begins = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield size, at, flat[begins[at][:, None] + np.arange(size)]


def tree(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Axis and cut of the upper kd-tree's nodes in heap order; cells is a power of two."""
    nodes: list[tuple[int, float]] = []
    parts = [points]
    while len(parts) < cells:
        below = []
        for part in parts:
            axis = int(np.argmax(part.max(0) - part.min(0))) if len(part) else 0
            cut = float(np.median(part[:, axis])) if len(part) else 0.0
            nodes.append((axis, cut))
            right = part[:, axis] > cut if len(part) else np.zeros(0, bool)
            below += [part[~right], part[right]]
        parts = below
    return nodes


def cell_of(points: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    axes, cuts = np.array([n[0] for n in nodes], np.int64), np.array([n[1] for n in nodes])
    depth = len(nodes).bit_length()
    for _ in range(depth if nodes else 0):
        at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] > cuts[at])
    return at - len(nodes)


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree that halves by rank, so equal points do no harm."""
    done, parts = [], [np.arange(len(points))]
    while parts:
        part = parts.pop()
        if len(part) <= LEAF:
            done.append(part)
            continue
        own = points[part]
        axis = int(np.argmax(own.max(0) - own.min(0)))
        order, half = np.argpartition(own[:, axis], len(part) // 2), len(part) // 2
        parts += [part[order[:half]], part[order[half:]]]
    return done


def _distance(low: np.ndarray, high: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distance of each point (rows) to each box (columns)."""
    total = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        at = points[:, axis][:, None]
        away = np.maximum(np.maximum(low[:, axis] - at, at - high[:, axis]), 0)
        total += away ** 2
    return total


def _merge(best: np.ndarray, best_ids: np.ndarray, query: np.ndarray, score: np.ndarray, found: np.ndarray) -> None:
    """Puts (query, score, id) in order of query into the queries' lists of best rows, in place."""
    k = best.shape[1]
    order = np.lexsort((found, -score, query))
    query, score, found = query[order], score[order], found[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    query, score, found, rank = (x[rank < k] for x in (query, score, found, rank))
    touched, row = np.unique(query, return_inverse=True)
    more, ids = np.full((len(touched), k), -np.inf), np.full((len(touched), k), np.iinfo(np.int64).max)
    more[row, rank], ids[row, rank] = score, found
    more, ids = np.concatenate((best[touched], more), 1), np.concatenate((best_ids[touched], ids), 1)
    ranked = np.lexsort((ids, -more), axis=1)[:, :k]
    best[touched], best_ids[touched] = (np.take_along_axis(x, ranked, 1) for x in (more, ids))


def search(ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
           projected: np.ndarray, bound: np.ndarray, k: int, longest: float,
           quantile: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores (query, k) of the best rows found; missing ones have score -inf. ``bound``: score that k rows
    elsewhere are known to reach."""
    leaves = _leaves(points)
    low = np.stack([points[leaf].min(0) for leaf in leaves])
    high = np.stack([points[leaf].max(0) for leaf in leaves])
    grouped = [vectors[leaf].T for leaf in leaves]
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    best = np.full((len(queries), k), -np.inf)
    square = (queries ** 2).sum(1)
    slack = 1e-15 * (vectors.shape[1] + 8) * np.sqrt(square * longest)  # more than a product can be off
    for begin in range(0, len(queries), QUERY_ROWS):
        part = slice(begin, min(begin + QUERY_ROWS, len(queries)))
        away = _distance(low, high, projected[part])
        order = np.argsort(away, 1, kind="stable")
        left, step, width = np.arange(part.start, part.stop), 0, 1
        while step < len(leaves) and len(left):
            reached = np.maximum(best[left, k - 1], bound[left])
            reach = square[left] + longest - 2 * reached
            # also ties of the k-th are looked at
            limit = quantile * np.maximum(reach, 0) * (1 + 1e-9) + 1e-12
            near = order[left - begin, step:step + width]
            go = away[left[:, None] - begin, near] <= limit[:, None]
            at, place = np.nonzero(go)
            leaf = near[at, place]
            by_leaf = np.argsort(leaf, kind="stable")
            at, leaf = at[by_leaf], leaf[by_leaf]
            ends = [*np.flatnonzero(np.diff(leaf)) + 1, len(leaf)]
            floor, pairs, start = reached - slack[left], [], 0
            for end in ends if len(leaf) else ():
                own = at[start:end]
                hit, row = np.nonzero(queries[left[own]] @ grouped[leaf[start]] >= floor[own][:, None])
                if len(hit):
                    pairs.append((left[own[hit]], leaves[leaf[start]][row]))
                start = end
            if pairs:
                query, row = (np.concatenate(x) for x in zip(*pairs))
                other = ids[row] != query_ids[query]
                query, row = query[other], row[other]
                score = np.concatenate([(vectors[row[i:i + EXACT_PAIRS]] * queries[query[i:i + EXACT_PAIRS]]).sum(-1)
                                        for i in range(0, max(len(row), 1), EXACT_PAIRS)])
                _merge(best, best_ids, query, score, ids[row])
            left, step, width = left[go[:, -1]], step + width, min(2 * width, MOST_LEAVES)
    return best_ids, best


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            dims: int = 8, confidence: float = 0.97, block_rows: int = 8192, sample_rows: int = 20_000,
            block_queries: int = 65_536, seed: int = 0) -> DataFrame:
    """(query_id, rank, key, score) of the k rows with the largest inner product; ``is_query`` tests the column _id."""
    rows, sizes = usable(vectors, key, vector)
    kind = vectors.schema[key].dataType
    # the last row is for the additional coordinate
    matrix = np.random.default_rng(seed).standard_normal((max(sizes, default=0) + 1, dims))
    quantile = chi_square(confidence, dims)
    longest = {size: x for size, (_, x) in sizes.items()}

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, flat = np.zeros((2, batch.num_rows, dims))
            for size, at, v in by_size(batch.column("_v")):
                flat[at] = v @ matrix[:size]  # as a query: the additional coordinate is 0
                rest = np.sqrt(np.maximum(longest[size] - (v ** 2).sum(1), 0))
                points[at] = flat[at] + rest[:, None] * matrix[-1]
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dims).cast(pa.list_(pa.float64()))
                     for x in (points, flat)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_v"), *lists], ["_id", "_v", "_p", "_q"])

    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField("_id", kind), *[T.StructField(n, doubles) for n in ("_v", "_p", "_q")]])
    rows = staged(rows.mapInArrow(projected, schema), "projected")
    total = sum(n for n, _ in sizes.values())
    block_rows = max(block_rows, total // MOST_BLOCKS)
    sample = rows.select(F.xxhash64("_id").alias("_o"), "_id", "_p").orderBy("_o", "_id").limit(sample_rows)
    points = np.array([r["_p"] for r in sample.collect()]).reshape(-1, dims)
    nodes = tree(points, 1 << max(0, (max(total, 1) // block_rows).bit_length()))
    first_cell, cells = {}, 0
    for size, (n, _) in sizes.items():
        first_cell[size], cells = cells, cells + (len(nodes) + 1 if n > block_rows else 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(pc.list_value_length(batch.column("_v"))).tolist()
            begin = np.array([first_cell[s] for s in size], np.int64)
            cut = np.array([sizes[s][0] > block_rows for s in size], bool)
            found = [begin + cut * cell_of(np.asarray(batch.column(c).flatten()).reshape(-1, dims), nodes) for c in ("_p", "_q")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], [*batch.schema.names, "_cell", "_home"])

    rows = rows.mapInArrow(placed, T.StructType([*schema, T.StructField("_cell", T.LongType()), T.StructField("_home", T.LongType())]))
    rows = staged(rows, "placed")
    parts = rows.groupBy("_cell").agg(F.ceil(F.count("*") / block_rows).alias("_parts"))
    # one row per cell, of which there are at most 2 * MOST_BLOCKS, and one for each rare length
    rows = staged(rows.join(F.broadcast(parts), "_cell").withColumn("_block", F.pmod(F.xxhash64("_id"), "_parts")), "blocks")
    extent = [f(F.get("_p", i)).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(dims)]
    boxes = (rows.groupBy("_cell", "_block").agg(F.max(F.size("_v")).alias("_size"), *extent)
             .orderBy("_cell", "_block").toPandas())
    cell, block, box_size = (boxes[c].to_numpy(np.int64) for c in ("_cell", "_block", "_size"))
    low = boxes[[f"low{i}" for i in range(dims)]].to_numpy(float)
    high = boxes[[f"high{i}" for i in range(dims)]].to_numpy(float)

    asked = schema.fields[:2] + [T.StructField("_q", doubles), T.StructField("_home", T.LongType()), T.StructField("_bound", T.DoubleType())]
    to = T.StructType([*asked, T.StructField("_cell", T.LongType()), T.StructField("_block", T.LongType())])

    def passing(batch: pa.RecordBatch) -> np.ndarray:
        """Per query and box whether rows of the box may reach the query's bound."""
        q = np.asarray(batch.column("_q").flatten()).reshape(-1, dims)
        bound, go = np.asarray(batch.column("_bound")), np.zeros((batch.num_rows, len(cell)), bool)
        for size, at, v in by_size(batch.column("_v")):
            reach = (v ** 2).sum(1) + longest[size] - 2 * bound[at]
            limit = quantile * np.maximum(reach, 0) * (1 + 1e-9) + 1e-12
            go[at] = (box_size == size) & (_distance(low, high, q[at]) <= limit[:, None])
        return go

    def routed(first: bool):
        """A row for each block that the query has to visit: those of its cell at first, then the others that pass."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, ROUTED_ROWS):
                    batch = whole.slice(at, ROUTED_ROWS)
                    home = np.asarray(batch.column("_home"))[:, None] == cell[None]
                    row, box = np.nonzero(home if first else ~home & passing(batch))
                    for i in range(0, len(row), EXACT_PAIRS):
                        sent = batch.take(pa.array(row[i:i + EXACT_PAIRS]))
                        own = box[i:i + EXACT_PAIRS]
                        yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(cell[own]), pa.array(block[own])], to.names)
        return run

    found = T.StructType([T.StructField("query_id", kind), T.StructField(key, kind), T.StructField("score", T.DoubleType())])

    def visited(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query_id": [], key: [], "score": []}).astype({"query_id": "int64", key: "int64"})
        parts = [np.stack(data[c].to_numpy()) for c in ("_v", "_p")]
        ids, scores = search(data["_id"].to_numpy(np.int64), *parts, queries["_id"].to_numpy(np.int64),
                             np.stack(queries["_v"].to_numpy()), np.stack(queries["_q"].to_numpy()),
                             queries["_bound"].to_numpy(float), k, longest[parts[0].shape[1]], quantile)
        good = ~np.isneginf(scores)
        return pd.DataFrame({"query_id": np.repeat(queries["_id"].to_numpy(), good.sum(1)), key: ids[good],
                             "score": scores[good]})

    def visits(queries: DataFrame, first: bool) -> DataFrame:
        sent = queries.select("_id", "_v", "_q", "_home", "_bound").mapInArrow(routed(first), to)
        place = ["_cell", "_block"]
        blocks = rows.select("_id", "_v", "_p", *place)
        if n_queries > block_queries:
            # one row per block
            slices = staged(sent.groupBy(*place).agg(F.ceil(F.count("*") / block_queries).alias("_slices")), "slices")
            sent = sent.join(F.broadcast(slices), place).withColumn("_slice", F.pmod(F.xxhash64("_id"), "_slices")).drop("_slices")
            blocks = (blocks.join(F.broadcast(slices), place)
                      .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1))).drop("_slices"))
            place = [*place, "_slice"]
        return blocks.groupBy(*place).cogroup(sent.groupBy(*place)).applyInPandas(visited, found)

    queries = rows.where(is_query)
    n_queries = queries.count()
    begun = staged(visits(queries.withColumn("_bound", F.lit(float("-inf"))), True), "found-at-home")
    order = f"partition by query_id order by score desc, {key}"
    bounds = (begun.withColumn("_n", F.expr(f"row_number() over ({order})")).where(F.col("_n") == k)
              .select(F.col("query_id").alias("_of"), F.col("score").alias("_bound")))
    queries = queries.join(bounds, F.col("_id") == F.col("_of"), "left").withColumn(
        "_bound", F.coalesce("_bound", F.lit(float("-inf"))))
    every = begun.union(visits(queries, False)).withColumn("rank", F.expr(f"row_number() over ({order})"))
    return every.where(F.col("rank") <= k).select("query_id", "rank", key, "score")

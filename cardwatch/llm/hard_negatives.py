"""Hard negatives: for each anchor and each of its nearest positives, the best rows of other labels within a window of
scores below the positive's.

A row's score is its integer inner product with the anchor; components become floor(scale * x). The window of a positive
with score p is ``least`` * p <= 100 * score <= ``most`` * p. The upper limits of an anchor's positives split its scores
into disjoint slots, so that the k best of each slot answer every window, however the windows overlap: the slots below a
positive's limit, merged from there on downwards, give its k best, and those under its lower limit are dropped.

Anchors are a stated set of queries against all rows. Rows are dealt into blocks of bounded size, and each block's task
holds its rows and lets the anchors stream past, sorted behind the rows. For each anchor it hands on at most
``positives`` rows in the first pass, and ``k`` rows a slot in the second; these are combined per anchor.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors of
another length than the anchor's have no score; empty vectors score 0; an anchor is no candidate of its own, while other
rows with its id are; of equal scores the smaller id comes first; a negative positive score has an empty window; scores
beyond the range of long count as its end; repeated anchor rows give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.work import staged

#: Scores held at once, and rows that are worth a task of their own.
SCORES = 1 << 20
LEAST_ROWS = 4096
ENDS = (-(1 << 63), (1 << 63) - 1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products (left, right) of whole numbers held as doubles."""
    if not left.shape[1]:
        return np.zeros((len(left), len(right)), np.int64)
    if float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1] < 2 ** 53:
        return (left @ right.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(left).dot(whole(right).T), *ENDS).astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest allowed scores of each row; of equal ones the first columns."""
    rows, columns = [], []
    allowed = allowed.copy()
    every = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        shown = np.where(allowed, scores, ENDS[0])
        at = shown.argmax(1)
        at = np.where(allowed[every, at], at, allowed.argmax(1))  # an allowed score may be the smallest number
        there = allowed[every, at]
        rows.append(every[there])
        columns.append(at[there])
        allowed[every, at] = False
    return np.concatenate(rows or [every[:0]]), np.concatenate(columns or [every[:0]])


class Block:
    """Rows of one block by length of the vector, each part in order of the ids."""

    def __init__(self, batches: list[pa.RecordBatch], scale: float):
        table = pa.Table.from_batches(batches)
        self.parts = {}
        lengths = np.asarray(pc.list_value_length(table["_v"]))
        for size in np.unique(lengths):
            part = table.filter(pa.array(lengths == size)).sort_by([("_id", "ascending"), ("_row", "ascending")]).combine_chunks()
            self.parts[int(size)] = (part, matrix(part["_v"], int(size), scale), np.asarray(part["_row"]),
                                     part["_label"].to_numpy())


def matrix(vectors: pa.ChunkedArray | pa.Array, size: int, scale: float) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    with np.errstate(over="ignore"):
        found = np.floor(np.asarray(vectors.flatten(), float) * scale)
    return np.nan_to_num(found).reshape(len(vectors), size)


def _streamed(scale: float, names: list[str], chosen: Callable):
    """Rows of a block, then the anchors that meet it; ``chosen`` yields the columns to hand on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, current = [], None, None
        for whole in batches:
            part, kind = np.asarray(whole.column("_part")), np.asarray(whole.column("_kind"))
            edges = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])))
            for start, stop in zip(edges, np.append(edges[1:], len(part))):
                batch = whole.slice(start, stop - start)
                if part[start] != current:
                    held, block, current = [], None, part[start]
                if kind[start] == 0:
                    held.append(batch)
                elif held:
                    block = block or Block(held, scale)
                    lengths = np.asarray(pc.list_value_length(batch.column("_v")))
                    for size in np.unique(lengths):
                        if int(size) in block.parts:
                            rows, values, keys, labels = block.parts[int(size)]
                            anchors = batch.filter(pa.array(lengths == size))
                            step = max(1, SCORES // max(1, len(values)))
                            for at in range(0, anchors.num_rows, step):
                                some = anchors.slice(at, step)
                                asked = matrix(some.column("_v"), int(size), scale)
                                columns = chosen(some, asked, rows, values, keys, labels)
                                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _positives(k: int):
    def chosen(anchors, asked, rows, values, keys, labels):
        label, own = anchors.column("_label").to_numpy(zero_copy_only=False), np.asarray(anchors.column("_row"))
        found = []
        for one in np.unique(label):
            at, same = np.flatnonzero(label == one), np.flatnonzero(labels == one)
            if len(same):
                scores = products(asked[at], values[same])
                row, column = best(scores, keys[same][None] != own[at][:, None], k)
                found.append((at[row], same[column], scores[row, column]))
        row, column, score = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
        return [pa.array(own[row]), rows["_id"].combine_chunks().take(pa.array(column)), pa.array(score)]
    return chosen


def _negatives(k: int):
    def chosen(anchors, asked, rows, values, keys, labels):
        label, own = anchors.column("_label").to_numpy(zero_copy_only=False), np.asarray(anchors.column("_row"))
        limits = [np.asarray(x, np.int64) for x in anchors.column("_limits").to_pylist()]
        least = np.asarray(anchors.column("_least"))
        scores = products(asked, values)
        other = (labels[None] != label[:, None]) & (scores >= least[:, None])
        found = []
        for slot in range(max(map(len, limits))):
            with_slot = np.flatnonzero([len(x) > slot for x in limits])
            high = np.array([limits[i][slot] for i in with_slot])
            below = np.array([limits[i][slot + 1] if len(limits[i]) > slot + 1 else ENDS[0] for i in with_slot])
            some = scores[with_slot]
            inside = other[with_slot] & (some <= high[:, None]) & (some > below[:, None])
            row, column = best(some, inside, k)
            found.append((with_slot[row], np.full(len(row), slot), column, some[row, column]))
        row, slot, column, score = (np.concatenate(x) for x in zip(*found))
        return [pa.array(own[row]), pa.array(slot), rows["_id"].combine_chunks().take(pa.array(column)), pa.array(score)]
    return chosen


def _limit(score: Column, hundredths: int, rounded) -> Column:
    """The score's share as a whole number, in decimals that cannot overflow."""
    return rounded(score.cast("decimal(20,0)") * F.lit(hundredths).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")).cast("bigint")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, k: int = 3, least: int = 50, most: int = 95,
         key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0,
         block_bytes: int = 1 << 25) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` tests the column _id.

    ``least`` and ``most`` are hundredths of the positive's score, from 0 to 100; ``block_bytes`` bounds the vectors that
    a task holds.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType
    rows = vectors.select(F.col(key).alias("_id"), F.col(label).cast("string").alias("_label"),
                          F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.where("_id is not null and _label is not null and _v is not null").where(
        F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    count, numbers = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("_v")), F.lit(0))).first()
    parallel = min(int(spark.conf.get("spark.sql.shuffle.partitions")), count // LEAST_ROWS)
    blocks = max(1, -(-8 * int(numbers) // block_bytes), parallel)
    data = rows.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(blocks))).withColumn("_kind", F.lit(0))
    anchors = rows.where(is_anchor)

    def met(asked: DataFrame, chosen, names: dict[str, T.DataType]) -> DataFrame:
        """What each block hands on for each of the anchors."""
        sent = asked.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).withColumn("_kind", F.lit(1))
        both = data.unionByName(sent, allowMissingColumns=True)
        dealt = both.repartition(blocks, "_part").sortWithinPartitions("_part", "_kind")
        return dealt.mapInArrow(_streamed(scale, list(names), chosen),
                                T.StructType([T.StructField(n, t) for n, t in names.items()]))

    whole = T.LongType()
    near = met(anchors, _positives(positives), {"_anchor": whole, "_positive": kind, "_score": whole})
    near = near.withColumn("_place", F.expr("row_number() over (partition by _anchor order by _score desc, _positive)"))
    windows = near.where(F.col("_place") <= positives).select(
        "_anchor", F.struct("_place", "_positive", "_score", _limit(F.col("_score"), most, F.floor).alias("high"),
                            _limit(F.col("_score"), least, F.ceil).alias("low")).alias("w")).where("w.low <= w.high")
    windows = staged(windows.groupBy("_anchor").agg(
        F.sort_array(F.collect_list("w")).alias("_windows"), F.min("w.low").alias("_least"),
        F.sort_array(F.collect_set("w.high"), asc=False).alias("_limits")), "windows")
    asked = staged(anchors.join(windows, F.col("_row") == F.col("_anchor")).drop("_anchor"), "asked")
    slots = met(asked.drop("_windows"), _negatives(k), {"_anchor": whole, "_slot": whole, "_negative": kind, "_score": whole})
    slots = slots.withColumn("_place", F.expr("row_number() over (partition by _anchor, _slot order by _score desc, _negative)"))
    # at most positives * k rows an anchor
    merged = slots.where(F.col("_place") <= k).groupBy("_anchor").agg(F.collect_list(F.struct(
        F.col("_slot").alias("slot"), F.col("_place").alias("place"), F.col("_score").alias("score"),
        F.col("_negative").alias("id"))).alias("_found"))
    # slots go down from the highest limit, so their order is that of the scores
    pairs = merged.join(asked.select("_row", F.col("_id").alias("anchor_id"), "_windows", "_limits"), F.col("_row") == F.col("_anchor"))
    pairs = pairs.withColumn("_found", F.sort_array("_found")).select(
        "anchor_id", "_found", "_limits", F.explode("_windows").alias("w"))
    below = F.slice(F.filter("_found", lambda x: x["slot"] >= F.array_position("_limits", F.col("w.high")) - 1), 1, k)
    out = pairs.select("anchor_id", "w", F.posexplode(F.filter(below, lambda x: x["score"] >= F.col("w.low"))).alias("_at", "n"))
    return out.select("anchor_id", F.col("w._positive").alias("positive_id"), (F.col("_at") + 1).cast("int").alias("rank"),
                      F.col("n.id").alias("negative_id"), F.col("w._score").alias("positive_score"),
                      F.col("n.score").alias("negative_score"))

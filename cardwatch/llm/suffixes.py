"""Suffix dedup by a sparse suffix array: suffixes at content-selected minimiser positions, sorted, compared with their
neighbours, and matches extended to both sides.

A passage of ``words`` words has ``words - rank + 1`` suffix starts with ``rank`` words inside the passage; the one with
the smallest fingerprint of its first ``gram`` words is retained wherever the passage stands. About two of
``words - rank + 2`` suffixes are retained. They are sorted by (fingerprint of their first ``rank`` words, document,
position) over range partitions, so that a passage of very many documents spreads over several tasks. Each suffix is
compared with its neighbour, the one before it of another document. Neighbours with the same ``rank`` words match.

The neighbour need not be the longest match: it may be an edited copy that ends too soon. So the whole windows of
``words`` words around every suffix whose ``rank`` words stand in two documents are hashed as well, and each is linked
to its first document and place. A repeated window holds a suffix that is retained wherever it stands, so all of them
are found: each word of a passage of ``words`` words of an earlier document is reported.

Matches of the same two documents at the same distance that follow each other become one, and its ends are extended
by at most ``words - rank`` words, word by word. Matches of at least ``words`` words are repeats; the other document has
the smaller id, so the first document of a passage keeps it. A passage can be reported with its neighbour and its first
document.

Sorting streams: a task holds one batch and the two rows before it, and the rows at the borders of partitions, a few
for each, are compared afterwards. Texts are read for the selection, and twice more, shuffled and only where suffixes
are shared, for the windows and for the words at the ends.

Defined cases: null, empty and short texts have no suffix; rows without an id take no part; rows with equal ids are one
document that does not repeat itself; repeats inside one document are not reported; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.work import discard, staged

Batches = Iterator[pa.RecordBatch]
LINK, HEAD, TAIL = 0, 1, 2


def _select(words: int, rank: int, gram: int):
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                text = W.split(batch.column("_text"))
                at, suffix = text.grams(rank)
                begin, small = text.grams(gram)
                order = small[np.searchsorted(begin, at)] if len(at) else small[:0]
                best, complete = W.window_best(at, order, text.text, words - rank + 1)
                chosen = np.unique(best[complete])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(suffix[chosen])), batch.column("_id").take(pa.array(text.text[at[chosen]])),
                     pa.array((at[chosen] - text.first[text.text[at[chosen]]]).astype(np.int32))], ["_key", "_id", "_pos"])
    return run


def _neighbours():
    """Over sorted rows: LINK rows with the neighbour of another id; HEAD rows whose neighbour may be in the partition
    before; TAIL rows, the last two ids' last rows of the partition."""
    def made(what: int, part: int, table: pa.Table, at: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
        rows = table.take(pa.array(at))
        others = table.take(pa.array(other))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), what, np.int32)), pa.array(np.full(len(at), part, np.int32)),
             *[rows.column(c).combine_chunks() for c in ("_key", "_id", "_pos")],
             *[others.column(c).combine_chunks() for c in ("_id", "_pos")]],
            ["_what", "_part", "_key", "_id", "_pos", "_id0", "_pos0"])

    def run(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        carry: pa.Table | None = None
        first = True  # still in the first (key, id) of the partition
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch.select(["_key", "_id", "_pos"])])
            held = carry.num_rows if carry else 0
            if carry:
                table = pa.concat_tables([carry, table]).combine_chunks()
            key = np.asarray(table.column("_key"))
            ids = table.column("_id").combine_chunks()
            differ = np.asarray(pc.not_equal(ids[1:], ids[:-1])) if len(ids) > 1 else np.zeros(0, bool)
            start = np.concatenate(([True], differ | (key[1:] != key[:-1])))
            begin = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))
            rows = np.arange(held, len(key))
            before = begin[rows] - 1
            linked = (before >= 0) & (key[np.maximum(before, 0)] == key[rows])
            yield made(LINK, part, table, rows[linked], before[linked])
            if first:
                open_rows = rows[begin[rows] == 0]
                yield made(HEAD, part, table, open_rows, open_rows)
                first = bool(begin[-1] == 0)
            last = len(key) - 1
            carry = table.take(pa.array([begin[last] - 1, last] if begin[last] > 0 else [last]))
        if carry:
            yield made(TAIL, part, carry, np.arange(carry.num_rows), np.arange(carry.num_rows))
    return run


def _windows(words: int, rank: int):
    """Every window of ``words`` words that holds one of the asked suffixes of a text."""
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                text = W.split(batch.column("_text"))
                at, window = text.grams(words)
                asked = batch.column("_at")
                owner = np.repeat(np.arange(batch.num_rows), np.asarray(asked.value_lengths().fill_null(0)))
                place = np.asarray(asked.flatten()).astype(np.int64) + text.first[owner]
                inside = place < text.first[owner + 1]  # rows with equal ids are asked for each other's places
                owner, place = owner[inside], place[inside]
                wanted = np.zeros(len(text.start) + 1, np.int64)  # +1 where a span of starts begins, -1 behind it
                np.add.at(wanted, np.maximum(place - (words - rank), text.first[owner]), 1)
                np.add.at(wanted, place + 1, -1)
                chosen = np.flatnonzero(np.cumsum(wanted)[at] > 0)
                owner = text.text[at[chosen]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(window[chosen])), batch.column("_id").take(pa.array(owner)),
                     pa.array((at[chosen] - text.first[owner]).astype(np.int32))], ["_key", "_id", "_pos"])
    return run


def _ends(reach: int):
    """The words before and behind each asked position of a text, as fingerprints."""
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                text = W.split(batch.column("_text"))
                short = (text.hash[0] >> np.uint64(33)).astype(np.int32)
                asked = batch.column("_at")
                owner = np.repeat(np.arange(batch.num_rows), np.asarray(asked.value_lengths().fill_null(0)))
                at = np.asarray(asked.flatten()).astype(np.int64) + text.first[owner]
                low, high = text.first[owner], text.first[owner + 1]
                at = np.clip(at, low, high)
                left, right = np.maximum(at - reach, low), np.minimum(at + reach, high)

                def spans(a: np.ndarray, b: np.ndarray, back: bool) -> pa.ListArray:
                    size = b - a
                    where = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                    index = np.repeat(b, size) - 1 - where if back else np.repeat(a, size) + where
                    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)),
                                                    pa.array(short[index]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(owner)), pa.array((at - low).astype(np.int32)),
                     spans(left, at, True), spans(at, right, False)], ["_id", "_at", "_left", "_right"])
    return run


def repeats(docs: DataFrame, words: int = 50, rank: int = 40, gram: int = 8, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(key, start_word, end_word, n_words, kept_<key>, kept_start_word): words start to end, counted from 0 and end
    excluded, also stand in the kept document, which has a smaller id."""
    docs = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    kind = docs.schema["_id"].dataType
    row = [T.StructField("_key", T.LongType()), T.StructField("_id", kind), T.StructField("_pos", T.IntegerType())]
    suffixes = staged(docs.mapInArrow(_select(words, rank, gram), T.StructType(row)), "suffixes")
    ordered = suffixes.repartitionByRange("_key", "_id", "_pos").sortWithinPartitions("_key", "_id", "_pos")
    met = staged(ordered.mapInArrow(_neighbours(), T.StructType(
        [T.StructField("_what", T.IntegerType()), T.StructField("_part", T.IntegerType()), *row,
         T.StructField("_id0", kind), T.StructField("_pos0", T.IntegerType())])), "neighbours")
    heads, tails = met.where(F.col("_what") == HEAD), met.where(F.col("_what") == TAIL)
    # a few rows per partition
    tails = tails.select((F.col("_part") + 1).alias("_part"), "_key", F.col("_id").alias("_id0"), F.col("_pos").alias("_pos0"))
    border = (heads.drop("_id0", "_pos0", "_what").join(F.broadcast(tails), ["_part", "_key"])
              .where("_id0 <> _id").groupBy("_key", "_id", "_pos").agg(F.max(F.struct("_id0", "_pos0")).alias("_o"))
              .select("_key", "_id", "_pos", "_o._id0", "_o._pos0"))
    near = met.where(F.col("_what") == LINK).select("_key", "_id", "_pos", "_id0", "_pos0").union(border)
    shared = staged(near.select("_key").distinct(), "shared-suffixes")
    places = staged(suffixes.join(shared, "_key").groupBy("_id").agg(F.collect_set("_pos").alias("_at")), "shared-places")
    discard(suffixes, shared)
    windows = staged(docs.join(places, "_id").mapInArrow(_windows(words, rank), T.StructType(row)), "windows")
    discard(places)
    first = (windows.groupBy("_key").agg(F.min(F.struct("_id", "_pos")).alias("_o"), F.max("_id").alias("_last"))
             .where("_last <> _o._id").select("_key", F.col("_o._id").alias("_id0"), F.col("_o._pos").alias("_pos0")))
    first = staged(first, "first-windows")
    # a window is its first and its last suffix
    exact = windows.join(first, "_key").where("_id <> _id0").select("_id", "_id0", "_pos0", "_pos", F.explode(
        F.array(F.lit(0), F.lit(words - rank))).alias("_move"))
    exact = exact.select("_id", (F.col("_pos") + F.col("_move")).alias("_pos"), "_id0",
                         (F.col("_pos0") + F.col("_move")).alias("_pos0"))
    links = near.drop("_key").union(exact)
    links = links.withColumn("_shift", F.col("_pos") - F.col("_pos0"))
    pair = "partition by _id, _id0, _shift order by _pos"
    links = links.withColumn("_new", F.expr(f"coalesce(_pos - lag(_pos) over ({pair}) > {rank}, true)").cast("int"))
    links = links.withColumn("_run", F.expr(f"sum(_new) over ({pair})"))
    runs = staged(links.groupBy("_id", "_id0", "_shift", "_run").agg(
        F.min("_pos").alias("_from"), (F.max("_pos") + rank).alias("_to")), "matches")
    discard(met, windows, first)
    asked = [runs.select(F.col(i).alias("_id"), F.explode(F.array(F.col("_from") - move, F.col("_to") - move)).alias("_at"))
             for i, move in (("_id", F.lit(0)), ("_id0", F.col("_shift")))]
    asked = staged(asked[0].union(asked[1]).groupBy("_id").agg(F.collect_set("_at").alias("_at")), "asked")
    reach = words - rank
    around = T.StructType([T.StructField("_id", kind), T.StructField("_at", T.IntegerType()),
                           T.StructField("_left", T.ArrayType(T.IntegerType())),
                           T.StructField("_right", T.ArrayType(T.IntegerType()))])
    ends = staged(docs.join(asked, "_id").mapInArrow(_ends(reach), around), "ends")
    discard(asked)

    def at(table: DataFrame, name: str, side: str, given: str, where: str) -> DataFrame:
        found = ends.groupBy(F.col("_id").alias("_i"), F.col("_at").alias("_w")).agg(F.first(side).alias(given))
        return table.join(found, (F.col(name) == F.col("_i")) & (F.expr(where) == F.col("_w"))).drop("_i", "_w")

    runs = at(runs, "_id", "_left", "_l1", "_from")
    runs = at(runs, "_id0", "_left", "_l0", "_from - _shift")
    runs = staged(runs, "matches-left")
    runs = at(runs, "_id", "_right", "_r1", "_to")
    runs = at(runs, "_id0", "_right", "_r0", "_to - _shift")

    def common(a: str, b: str):
        """Length of the common beginning of two lists."""
        short = F.least(F.size(a), F.size(b))
        wrong = F.filter(F.sequence(F.lit(0), F.greatest(short, F.lit(1)) - 1), lambda i: F.get(F.col(a), i) != F.get(F.col(b), i))
        return F.when(short == 0, 0).when(F.size(wrong) > 0, wrong[0]).otherwise(short)

    start, end = F.col("_from") - common("_l1", "_l0"), F.col("_to") + common("_r1", "_r0")
    found = runs.select(F.col("_id").alias(key), start.alias("start_word"), end.alias("end_word"),
                        (end - start).alias("n_words"), F.col("_id0").alias(f"kept_{key}"),
                        (start - F.col("_shift")).alias("kept_start_word"))
    return found.where(F.col("n_words") >= words)

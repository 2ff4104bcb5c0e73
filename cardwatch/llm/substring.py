"""Substring dedup by level-wise doubling: windows repeated at one length alone are extended to twice that length.

A word is removed if a window of ``words`` consecutive words covers it whose word sequence also starts in a document
with a smaller id. Repeats are found in levels. Each window has an anchor: the smallest fingerprint among its runs of
``base`` words (7 of 13), which equal windows have in the same place. The first level counts anchors only, about two
for every ``words - base + 2`` words of text. Windows whose anchor is in one document alone are dropped; the others are
compared on twice the length from the anchor, and so on until the full length or until no candidate is left. The last
level compares 96-bit fingerprints of whole windows.

Every level is one aggregation (smallest and largest document per fingerprint, combined before the shuffle, so that a
passage in a third of all documents costs each task one row), and one join of narrow rows that adaptive execution can
split. Lists are per document and bounded by its length.

Defined cases: null and empty texts have no words; a null id is smaller than none and has none smaller, so its words
stay; rows with the same id do not remove each other's words, but both lose what a smaller id has; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.work import discard, staged

Batches = Iterator[pa.RecordBatch]


def lengths(words: int) -> list[int]:
    """Window lengths of the levels: each at most twice the one before, the last ``words``."""
    found = [words]
    while found[0] > 8:
        found.insert(0, (found[0] + 1) // 2)
    return found


def _anchors(text: W.Words, words: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Start word of each window of ``words`` words and of its anchor."""
    at, grams = text.grams(base)
    best, _ = W.window_best(at, grams, text.text, words - base + 1)
    count = max(len(text.start) - words + 1, 0)
    begin = np.flatnonzero(text.text[:count] == text.text[words - 1:words - 1 + count])
    return begin, at[best[np.searchsorted(at, begin)]] if len(begin) else begin


def _prints(text: W.Words, begin: np.ndarray, anchor: np.ndarray, words: int, length: int) -> list[np.ndarray]:
    """64 and 32 bits of fingerprint of the part of ``length`` words of each window that starts at its anchor, or ends with it."""
    where = np.minimum(anchor, begin + words - length)
    found = []
    for lane in (0, 1):
        at, grams = text.grams(length, lane)
        found.append(grams[np.searchsorted(at, where)] if len(where) else np.zeros(0, np.uint64))
    return [found[0], found[1] & np.uint64(0xFFFFFFFF)]


def _member(owner: np.ndarray, prints: list[np.ndarray], batch: pa.RecordBatch) -> np.ndarray:
    """Whether the owner's list in the batch holds the pair of fingerprints."""
    inside = np.ones(len(owner), bool)
    for lane, value in enumerate(prints):
        column = batch.column(f"_h{lane}")
        rows = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths().fill_null(0)))
        listed = np.asarray(column.flatten())
        listed = listed.view(np.uint64) if lane == 0 else listed.view(np.uint32).astype(np.uint64)
        key = W.mixed(listed + W.mixed(rows.astype(np.uint64)))
        inside &= np.isin(W.mixed(value + W.mixed(owner.astype(np.uint64))), key)
    return inside


def _level(words: int, base: int, before: int | None, length: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                text = W.split(batch.column("_text"), lanes=2)
                begin, anchor = _anchors(text, words, base)
                if before:
                    part = _prints(text, begin, anchor, words, before)[:1]
                    keep = _member(text.text[begin], part, batch)
                    begin, anchor = begin[keep], anchor[keep]
                first, second = _prints(text, begin, anchor, words, length)
                owner = text.text[begin]
                order = np.lexsort((second, first, owner))
                owner, first, second = owner[order], first[order], second[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(pa.array(owner[new])), pa.array(W.signed(first[new])),
                     pa.array(second[new].astype(np.uint32).view(np.int32))][:2 + (length == words)], ["_id", "_h0", "_h1"][:2 + (length == words)])
    return run


def _drop(words: int, base: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                text = W.split(batch.column("_text"), lanes=2)
                begin, anchor = _anchors(text, words, base)
                begin = begin[_member(text.text[begin], _prints(text, begin, anchor, words, words), batch)]
                edge = np.zeros(len(text.start) + 1, np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + words, -1)
                gone = np.cumsum(edge)[:-1] > 0
                total = np.concatenate(([0], np.cumsum(gone)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(np.diff(text.first)),
                     pa.array(total[text.first[1:]] - total[text.first[:-1]]), W.joined(text, ~gone)],
                    ["_id", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, words: int = 13, key: str = "doc_id", text: str = "text",
                   slices: int = 3) -> DataFrame:
    """(key, n_words, n_removed, kept): per row its words, how many go, and the rest joined by one blank."""
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    kind, levels = docs.schema["_id"].dataType, lengths(words)
    known, lists = docs.where("_id is not null"), None
    for before, length in zip([None, *levels], levels):
        last = length == words
        names = ["_h0", "_h1"] if last else ["_h0"]
        schema = T.StructType([T.StructField("_id", kind), T.StructField("_h0", T.LongType()),
                               T.StructField("_h1", T.IntegerType())][:1 + len(names)])
        given = known if lists is None else known.join(lists, "_id")
        rows = staged(given.mapInArrow(_level(words, levels[0], before, length), schema), f"windows-{length}")
        if lists is not None:
            discard(lists)
        found = []
        for part in range(slices if last else 1):  # disk holds the shuffle of one slice of the fingerprints at a time
            own = rows.where(F.pmod("_h0", F.lit(slices)) == part) if last else rows
            shared = staged(own.groupBy(*names).agg(F.min("_id").alias("_least"), F.max("_id").alias("_most"))
                            .where("_least < _most").drop("_most"), f"shared-{length}")
            own = own.join(shared, names)
            found.append(staged((own.where("_id > _least") if last else own).select("_id", *names), f"repeats-{length}"))
            discard(shared)
        discard(rows)
        lists = staged(functools.reduce(DataFrame.union, found).groupBy("_id").agg(
            *[F.collect_list(n).alias(n) for n in names]), f"lists-{length}")
        discard(*found)
    schema = T.StructType([T.StructField("_id", kind), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return (docs.join(lists, "_id", "left").mapInArrow(_drop(words, levels[0]), schema)
            .withColumnRenamed("_id", key))

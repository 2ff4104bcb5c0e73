"""SimHash near duplicates: fingerprints of word shingles, linked by a self-join over binary tries.

A document's fingerprint has bit b if more than half of its shingles (repeats included) have bit b in their 64-bit
XXH64. Two fingerprints link when they differ in at most ``budget`` bits; a document's component is the smallest id it
can reach over links.

1. Texts become fingerprints inside one scan; documents of equal fingerprint become one class by a combined aggregation.
2. The trie is dealt out by bits on which two linked fingerprints must agree: the bits are cut into ``budget`` + 1
   blocks, and a shard holds the fingerprints that agree on one block. A shard of more than ``shard_rows`` is dealt out
   again by blocks of the bits that are left, until none is larger; no link is lost by this, since some block of the
   left bits agrees too.
3. In a shard the sorted fingerprints are a binary trie whose nodes are ranges. Node pairs are followed together from the
   top: the pair's differing bits add up, and a pair is dropped as soon as they exceed the budget. This is done for
   budgets 1, 2, ... in turn, and pairs of nodes whose members are all connected already are dropped as well, so a
   dense group of near copies costs no square. A shard hands on the edges of a spanning forest, not all links.
4. Components of these edges give the result.

Tasks hold one batch of texts, or the shards of about ``shard_rows`` fingerprints and a bounded slice of node pairs.

Defined cases: texts with fewer words than a shingle have one shingle of all their words; null, empty and blank texts have
fingerprint zero and link like any other; rows with equal ids are rows of one document, each with its own fingerprint;
a row without an id has a fingerprint but no component and links with nothing; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.components import components
from cardwatch.llm.work import discard, staged

BITS = 64
SEED = 42
#: Shingles whose bits are counted at once, and node pairs that are followed at once.
COUNT_ROWS = 1 << 16
PAIR_ROWS = 1 << 18
#: Node pairs with at most so many fingerprint pairs are compared directly.
FEW = 8


def shingle_spans(words: W.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first and last word of every shingle; a text with fewer words has one of all its words."""
    n = np.diff(words.first)
    many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), many)
    begin = words.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    return owner, begin, np.minimum(begin + size, words.first[owner + 1]) - 1


def fingerprints(texts: pa.Array, size: int) -> np.ndarray:
    words = W.split(texts, lower=True)
    owner, begin, last = shingle_spans(words, size)
    plain = W.joined(words, np.ones(len(words.start), bool))
    data = (plain.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    # where each word stands in the texts joined by single blanks: no blank between two texts
    length = words.end - words.start
    gap = np.ones(len(length), np.int64)
    gap[words.first[1:][np.diff(words.first) > 0] - 1] = 0
    start = np.cumsum(length + gap) - length - gap
    left, right = start[begin], (start + length)[last]
    rows = len(words.first) - 1
    ones, total = np.zeros((rows, BITS), np.int64), np.bincount(owner, minlength=rows)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(owner), COUNT_ROWS):
        part = slice(at, at + COUNT_ROWS)
        h = np.array([digest(data[s:e], SEED) for s, e in zip(left[part].tolist(), right[part].tolist())], np.uint64)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = owner[part]
        edges = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprinted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(W.signed(fingerprints(batch.column("_text"), size)))], ["_id", "_print"])
    return run


def blocks(mask: int, budget: int) -> list[int]:
    """The mask with each of budget + 1 blocks of the bits that it leaves; as it is if there are too few bits."""
    left = [b for b in range(BITS) if not mask >> b & 1]
    parts = np.array_split(np.array(left, object), budget + 1)
    return [mask | sum(1 << int(b) for b in part) for part in parts] if len(left) > budget else [mask]


def _long(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def connect(prints: np.ndarray, shard: np.ndarray, budget: int) -> np.ndarray:
    """For each fingerprint the row that names its component within its shard.

    ``prints`` ascend within each shard; the rows of a shard are consecutive.
    """
    n = len(prints)
    label = np.arange(n)
    ones = np.zeros((BITS, n + 1), np.int32)
    for bit in range(BITS):
        np.cumsum(prints >> np.uint64(bit) & np.uint64(1), out=ones[bit, 1:], dtype=np.int32)
    first = np.flatnonzero(np.diff(shard, prepend=-1))
    stop = np.append(first[1:], n)
    whole = stop - first > 1
    top = np.stack((first[whole], stop[whole], first[whole], stop[whole], np.zeros(int(whole.sum()), np.int64)))
    for allowed in range(1, budget + 1):
        stack = [(BITS - 1, top)]
        while stack:
            bit, pairs = stack.pop()
            pairs = _open(pairs, label)
            if pairs.shape[1] > PAIR_ROWS:
                half = pairs.shape[1] // 2
                stack += [(bit, pairs[:, :half]), (bit, pairs[:, half:])]
                continue
            a0, a1, b0, b1, differ = pairs
            few = (a1 - a0) * (b1 - b0) <= FEW
            few |= bit < 0
            label = _compared(pairs[:, few], prints, label, allowed)
            pairs = pairs[:, ~few]
            if pairs.shape[1]:
                stack.append((bit - 1, _children(pairs, ones[bit], allowed)))
    return label


def _open(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Node pairs whose members are not all connected."""
    a0, a1, b0, b1, _ = pairs
    changes = np.cumsum(np.append(False, label[1:] != label[:-1]))
    same = (changes[a0] == changes[a1 - 1]) & (changes[b0] == changes[b1 - 1]) & (label[a0] == label[b0])
    return pairs[:, ~same]


def _children(pairs: np.ndarray, ones: np.ndarray, allowed: int) -> np.ndarray:
    a0, a1, b0, b1, differ = pairs
    am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
    own = a0 == b0
    cross = ~own
    parts = [np.stack((a0, am, b0, bm, differ)), np.stack((am, a1, bm, b1, differ)),
             np.stack((a0, am, bm, b1, differ + 1)), np.stack((am, a1, b0, bm, differ + 1))[:, cross]]
    found = np.concatenate(parts, 1)
    a0, a1, b0, b1, differ = found
    return found[:, (a1 > a0) & (b1 > b0) & (differ <= allowed) & ((a0 != b0) | (a1 - a0 > 1))]


def _compared(pairs: np.ndarray, prints: np.ndarray, label: np.ndarray, allowed: int) -> np.ndarray:
    """Labels after the links among the members of these pairs."""
    a0, a1, b0, b1, _ = pairs
    many = (a1 - a0) * (b1 - b0)
    pair = np.repeat(np.arange(len(many)), many)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
    x, y = a0[pair] + at // (b1 - b0)[pair], b0[pair] + at % (b1 - b0)[pair]
    near = np.bitwise_count(prints[x] ^ prints[y]) <= allowed
    return joined(label, x[near], y[near])


def joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels (each names a row that names itself) after linking the rows x and y."""
    while True:
        a, b = label[x], label[y]
        unlike = a != b
        if not unlike.any():
            return label
        x, y = x[unlike], y[unlike]
        low, high = np.minimum(a, b)[unlike], np.maximum(a, b)[unlike]
        np.minimum.at(label, high, low)
        while True:
            after = label[label]
            if np.array_equal(after, label):
                break
            label = after


def _spanning(shard_rows: int, budget: int):
    """Edges (a, b) of a spanning forest of each shard's links; rows come sorted by shard and fingerprint."""
    def edges(table: pa.Table) -> pa.RecordBatch:
        mask, value = np.asarray(table["_mask"]), np.asarray(table["_value"])
        prints = np.asarray(table["_print"]).view(np.uint64)
        shard = np.cumsum(np.append(False, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])))
        order = np.lexsort((prints, shard))
        label = connect(prints[order], shard, budget)
        moved = np.flatnonzero(label != np.arange(len(label)))
        rep = table["rep"].combine_chunks().take(pa.array(order))
        return pa.RecordBatch.from_arrays([rep.take(pa.array(label[moved])), rep.take(pa.array(moved))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            kept.append(batch)
            rows += batch.num_rows
            if rows >= shard_rows:
                table = pa.Table.from_batches(kept)
                mask, value = np.asarray(table["_mask"]), np.asarray(table["_value"])
                inside = np.flatnonzero((mask != mask[-1]) | (value != value[-1]))
                cut = int(inside[-1]) + 1 if len(inside) else 0  # the last shard may go on
                if cut:
                    yield edges(table.slice(0, cut))
                rest = table.slice(cut)
                kept, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield edges(pa.Table.from_batches(kept))
    return run


def linked(classes: DataFrame, budget: int, shard_rows: int) -> DataFrame:
    """Edges (a, b) between representatives, enough to connect whatever links connect; classes: (_print, rep)."""
    spark, kind = classes.sparkSession, classes.schema["rep"].dataType
    ends = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    first = F.explode(F.array(*[F.lit(_long(m)) for m in blocks(0, budget)])).alias("_mask")
    todo, found, again = classes.select("_print", "rep", first), None, True
    while again:
        dealt = staged(todo.withColumn("_value", F.col("_print").bitwiseAND(F.col("_mask"))), "shards")
        sizes = staged(dealt.groupBy("_mask", "_value").agg(F.count("*").alias("_n")).where("_n > 1"), "shard-sizes")
        small = dealt.join(sizes.where(F.col("_n") <= shard_rows), ["_mask", "_value"], "left_semi")
        edges = staged(small.repartition("_mask", "_value").sortWithinPartitions("_mask", "_value", "_print")
                       .select("_mask", "_value", "_print", "rep").mapInArrow(_spanning(shard_rows, budget), ends), "spanning")
        found = edges if found is None else found.union(edges)
        large = sizes.where(F.col("_n") > shard_rows)
        again = sorted(r[0] % (1 << BITS) for r in large.select("_mask").distinct().collect())
        if again:  # masks lead to budget + 1 others in each of a few rounds, whatever the number of shards
            finer = spark.createDataFrame([(_long(m), _long(x)) for m in again for x in blocks(m, budget)], "_of bigint, _mask bigint")
            left = dealt.join(large, ["_mask", "_value"], "left_semi").select("_print", "rep", F.col("_mask").alias("_of"))
            todo = staged(left.join(F.broadcast(finer), "_of").select("_print", "rep", "_mask"), "large-shards")
        discard(dealt, sizes)
    return found.distinct()


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, budget: int = 3,
            shard_rows: int = 1 << 15) -> DataFrame:
    """(key, fingerprint, component_id) per row; links at ``budget`` or fewer differing bits."""
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    kind = docs.schema["_id"].dataType
    marked = staged(docs.mapInArrow(_fingerprinted(size), T.StructType(
        [T.StructField("_id", kind), T.StructField("_print", T.LongType())])), "fingerprints")
    known = marked.where("_id is not null")
    classes = staged(known.groupBy("_print").agg(F.min("_id").alias("rep")), "print-classes")
    # rows of one id are one document, whatever their fingerprints
    twice = known.groupBy("_id").agg(F.min("_print").alias("_a"), F.max("_print").alias("_b")).where("_a <> _b")
    same = (known.join(twice.select("_id"), "_id", "left_semi").distinct().join(classes, "_print")
            .where("_id <> rep").select(F.col("_id").alias("a"), F.col("rep").alias("b")))
    named = components(linked(classes, budget, shard_rows).union(same))
    heads = staged(classes.join(named, F.col("rep") == F.col("node"), "left").select(
        "_print", F.coalesce("component", "rep").alias("component_id")), "print-components")
    out = marked.join(heads, "_print", "left")
    return out.select(F.col("_id").alias(key), F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id")).alias("component_id"))

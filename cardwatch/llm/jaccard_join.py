"""Jaccard join of word shingles: size-banded tiles, bitmap signatures, then exact sorted-array intersection.

Documents link when intersection / union of their shingle sets is at least ``share`` hundredths. All links count, none
is guessed: fingerprints of 64 bits stand for shingles.

1. A set's rows carry its size, a 128-bit fingerprint, its tiles (its smallest shingles by hash, enough of them that linked
   sets share one) and a bitmap with one parity bit per hash slot. Documents with equal sets become one class, by one
   combined aggregation.
2. A tile holds the classes that share one of those shingles in a band of sizes; linked sets lie in the same or in
   neighbouring bands. Slots in which two bitmaps differ bound the symmetric difference from below, hence the overlap
   from above. In sets too large for these bits a single shingle of a common passage would bring together what no bitmap
   tells apart. They are cut into more segments, by hash, than linked sets of two neighbouring bands can differ in
   elements, so that linked sets have a whole segment in common; a tile then holds those that share a segment of several
   shingles. Segments without elements count only for a set that has so many that the others need not decide.
3. First each class meets the smallest classes of its tiles only, and is compared with the one whose bitmap is closest.
   This takes rows in proportion to the tile, and the verified links already connect a large group of near copies. Then only classes that are not connected yet meet, with sizes
   and bitmaps tested inside the join, so pairs of one component and hopeless pairs are never rows.
4. Surviving pairs are tested once more on bitmaps of 8192 slots and then decided on the sorted arrays. Components of all links give the result.

Written tables are joined with each other, so adaptive execution splits the rows of a frequent shingle or of a class
that thousands meet. Tasks hold one batch of pairs; the driver holds nothing.

Defined cases: null, empty and blank texts have no shingles and link with nothing; texts with fewer words than a
shingle are one shingle of all their words; rows with equal ids are one document, each with its own number of shingles;
a null id links with nothing and its component is null; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.components import components
from cardwatch.llm.work import discard, staged

BITS = 512
WIDE_BITS = 8192
LANES = [f"b{i}" for i in range(BITS // 64)]


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, fingerprint) of each text's set, in order of the fingerprint."""
    words = W.split(texts, lower=True)
    at, found = words.grams(size)
    owners, values = [words.text[at]], [found]
    count = np.diff(words.first)
    for fewer in range(1, size):
        at, found = words.grams(fewer)
        whole = count[words.text[at]] == fewer
        owners.append(words.text[at][whole])
        values.append(found[whole])
    return W.distinct(np.concatenate(owners), np.concatenate(values))


def prefix_length(n: np.ndarray, share: int) -> np.ndarray:
    """Sets of these sizes cannot reach the share without a common element among so many first ones."""
    return np.where(n > 0, n - (share * n + 99) // 100 + 1, 0)


def band_width(share: int) -> float:
    """Logarithm of the ratio of sizes within a band; linked sets lie in the same or in neighbouring bands."""
    return math.log(100 / share) * 1.000001


def segment_counts(share: int, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most elements in which linked sets of a band and the next differ, and segments that sets of both are cut into."""
    largest = [np.ceil(np.exp((band + i) * band_width(share))) for i in (1, 2)]
    differ = ((largest[0] + largest[1]) * (100 - share) // (100 + share)).astype(np.int64)
    return differ, differ + differ // 10 + 4


def first_large(share: int) -> int:
    """The band from which on random parity bits would pass for those of linked sets."""
    return int(math.log(0.2 * BITS * (100 + share) / (100 - share)) / band_width(share))


def segments(owner: np.ndarray, value: np.ndarray, rows: int, share: int, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of the segments of sets that may link with sets of the given band or the next; a set without a band has -1."""
    mine = band[owner] >= 0
    owner, value = owner[mine], value[mine]
    differ, many = segment_counts(share, np.maximum(band, 0))
    many = np.where(band >= 0, many, 0)
    base = np.cumsum(many) - many
    at = base[owner] + (W.mixed(value ^ np.uint64(0x632BE59BD9B4E019)) % many[owner].astype(np.uint64)).astype(np.int64)
    total, count = np.zeros(int(many.sum()), np.uint64), np.bincount(at, minlength=int(many.sum()))
    np.add.at(total, at, W.mixed(value + np.uint64(0xA0761D6478BD642F)))
    of = np.repeat(np.arange(rows), many)
    empty = np.bincount(of[count == 0], minlength=rows)
    used = (count > 0) | (empty >= many - differ)[of]
    local = np.arange(len(of)) - base[of]
    key = W.mixed(total ^ W.mixed((local * 4096 + band[of]).astype(np.uint64)))
    return of[used], key[used]


def _signatures(size: int, share: int):
    large = first_large(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                rows = batch.num_rows
                owner, value = shingles(batch.column("_text"), size)
                n = np.bincount(owner, minlength=rows)
                begin = np.cumsum(n) - n
                local = np.arange(len(owner)) - np.repeat(begin, n)
                band = np.where(n > 0, np.floor(np.log(np.maximum(n, 1)) / band_width(share)), -1).astype(np.int64)
                first = (local < np.repeat(prefix_length(n, share), n)) & (band[owner] <= large)
                keys = [(owner[first], value[first])] + [
                    segments(owner, value, rows, share, np.where(b >= large, b, -1)) for b in (band, band - 1)]
                keys = W.distinct(*(np.concatenate(x) for x in zip(*keys)))
                prints = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.concatenate((np.zeros(1, np.uint64),
                                            np.cumsum(W.mixed(value ^ np.uint64(salt)), dtype=np.uint64)))
                    prints.append(W.signed(total[begin + n] - total[begin]))
                slot = (W.mixed(value + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)).astype(np.int64)
                parity = (np.bincount(owner * BITS + slot, minlength=rows * BITS) & 1).astype(np.uint8)
                lanes = np.packbits(parity.reshape(rows, BITS), axis=1).view(np.int64).reshape(rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(n), pa.array(band), pa.array(prints[0]), pa.array(prints[1]),
                     W.lists(keys[0], W.signed(keys[1]), rows, pa.int64()),
                     *[pa.array(np.ascontiguousarray(lanes[:, i])) for i in range(len(LANES))]],
                    ["_id", "n", "band", "f0", "f1", "_prefix", *LANES])
    return run


def _sets(size: int):
    """The whole sets, with their sizes and wide bitmaps, which long texts do not saturate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "_text"):
                owner, value = shingles(batch.column("_text"), size)
                rows = batch.num_rows
                wide = np.zeros((rows, WIDE_BITS // 8), np.uint8)
                slot = (W.mixed(value + np.uint64(0x9FB21C651E98DF25)) % np.uint64(WIDE_BITS)).astype(np.int64)
                np.bitwise_xor.at(wide, (owner, slot >> 3), (1 << (slot & 7)).astype(np.uint8))
                offsets = np.arange(rows + 1, dtype=np.int32) * (WIDE_BITS // 8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(np.bincount(owner, minlength=rows)),
                     pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(wide.tobytes())]),
                     W.lists(owner, W.signed(value), rows, pa.int64())], ["_id", "_n", "_wide", "_set"])
    return run


def _hopeful_wide(share: int):
    """Pairs whose wide bitmaps allow the share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                           for c in ("_wa", "_wb"))
            differ = np.bitwise_count(left ^ right).sum(1, dtype=np.int64)
            total = np.asarray(batch.column("_na")) + np.asarray(batch.column("_nb"))
            yield batch.select(["a", "b"]).filter(pa.array(differ * (100 + share) <= total * (100 - share)))
    return run


def _linked(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("_left"), batch.column("_right")
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = np.asarray(left[i].values), np.asarray(right[i].values)
                both = np.concatenate((a, b))
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = 100 * common >= share * (len(a) + len(b) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _differ(left: str, right: str) -> Column:
    total = F.lit(0)
    for lane in LANES:
        total = total + F.bit_count(F.col(f"{left}.{lane}").bitwiseXOR(F.col(f"{right}.{lane}")))
    return total


def _hopeful(left: str, right: str, share: int) -> Column:
    """Sizes and bitmaps allow the share."""
    total = F.col(f"{left}.n") + F.col(f"{right}.n")
    return _sizes(left, right, share) & (_differ(left, right) * (100 + share) <= total * (100 - share))


def _sizes(left: str, right: str, share: int) -> Column:
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    return F.least(a, b) * 100 >= F.greatest(a, b) * share


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, share: int = 80) -> DataFrame:
    """(key, n_shingles, component_id) per row; ``share`` in hundredths, ``size`` in words."""
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    kind = docs.schema["_id"].dataType
    fields = [T.StructField("_id", kind), T.StructField("n", T.LongType()), T.StructField("band", T.LongType()), T.StructField("f0", T.LongType()),
              T.StructField("f1", T.LongType()), T.StructField("_prefix", T.ArrayType(T.LongType())),
              *[T.StructField(lane, T.LongType()) for lane in LANES]]
    marked = staged(docs.mapInArrow(_signatures(size, share), T.StructType(fields)), "signatures")
    known = marked.where("n > 0 and _id is not null")
    # equal sets have equal prefixes and bitmaps
    classes = staged(known.groupBy("n", "f0", "f1").agg(
        F.min("_id").alias("rep"), F.first("band").alias("band"), F.first("_prefix").alias("_prefix"), *[F.first(lane).alias(lane) for lane in LANES]),
        "classes")

    heads = classes.select("rep", "n", "band", F.explode("_prefix").alias("key"))
    shared = staged(heads.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select("key"), "shared-shingles")
    tiles = staged(heads.join(shared, "key"), "tiles")
    discard(shared)
    drawn = classes.select("rep", "n", *LANES)

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        """Links among the pairs (a, b) of representatives."""
        pairs = staged(pairs.distinct(), f"{label}-pairs")
        active = staged(pairs.select(F.col("a").alias("_rep")).union(pairs.select("b")).distinct(), f"{label}-active")
        sets = staged(docs.join(active.hint("merge"), F.col("_id") == F.col("_rep")).select("_id", "_text").mapInArrow(
            _sets(size), T.StructType([fields[0], T.StructField("_n", T.LongType()), T.StructField("_wide", T.BinaryType()),
                                       T.StructField("_set", T.ArrayType(T.LongType()))])), f"{label}-sets")
        ends = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
        wide = pairs
        for end in ("a", "b"):
            wide = wide.join(sets.select(F.col("_id").alias(end), F.col("_n").alias(f"_n{end}"),
                                         F.col("_wide").alias(f"_w{end}")), end)
        close = staged(wide.mapInArrow(_hopeful_wide(share), ends), f"{label}-close")
        # one of both sets is shuffled with each pair, the other once
        full = close.join(sets.select(F.col("_id").alias("a"), F.col("_set").alias("_left")), "a").join(sets.select(F.col("_id").alias("b"), F.col("_set").alias("_right")), "b")
        found = staged(full.select("a", "b", "_left", "_right").mapInArrow(_linked(share), ends).distinct(),
                       f"{label}-links")
        discard(pairs, active, close, sets)
        return found

    def pair(left: str, right: str) -> list[Column]:
        return [F.least(f"{left}.rep", f"{right}.rep").alias("a"), F.greatest(f"{left}.rep", f"{right}.rep").alias("b")]

    pivots = staged(tiles.groupBy("key", "band").agg(F.min(F.struct("rep", "n")).alias("p")).select("key", "band", "p.*"),
                    "pivots")
    met = tiles.withColumn("_to", F.explode(F.array(F.col("band"), F.col("band") - 1))).alias("x").join(
        pivots.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x._to") == F.col("y.band"))
        & (F.col("x.rep") != F.col("y.rep")) & _sizes("x", "y", share)).select(F.col("x.rep").alias("_x"), F.col("y.rep").alias("_y")).distinct()
    met = staged(met, "near-met")
    near = met.join(drawn.alias("x"), F.col("_x") == F.col("x.rep")).join(drawn.alias("y"), F.col("_y") == F.col("y.rep"))
    # of its tiles' smallest classes, the one that looks most alike; the others are met below, if still unconnected
    near = near.where(_hopeful("x", "y", share)).groupBy("_x").agg(
        F.min(F.struct(_differ("x", "y").alias("differ"), F.col("_y"))).alias("_m"))
    links = verified(near.select(F.least("_x", "_m._y").alias("a"), F.greatest("_x", "_m._y").alias("b")), "near")
    discard(pivots, met)
    named = components(links)

    open_tiles = staged(tiles.join(named, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "band", F.coalesce("component", "rep").alias("component")), "tiles-named")
    discard(tiles)
    mixed = staged(open_tiles.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
                   .where("_a <> _b").select("key"), "mixed-tiles")
    mixed_tiles = staged(open_tiles.join(mixed, "key").join(drawn, "rep"), "tiles-open")
    discard(mixed, open_tiles)
    x = mixed_tiles.withColumn("_to", F.explode(F.array(F.col("band"), F.col("band") + 1))).alias("x")
    far = x.join(mixed_tiles.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x._to") == F.col("y.band"))
                 & (F.col("x.component") != F.col("y.component"))
                 & ((F.col("x._to") != F.col("x.band")) | (F.col("x.rep") < F.col("y.rep")))
                 & _hopeful("x", "y", share)).select(*pair("x", "y"))
    more = verified(far, "far")
    discard(mixed_tiles)
    named = components(links.union(more))

    heads = staged(classes.select("n", "f0", "f1", "rep").join(named, F.col("rep") == F.col("node"), "left").select(
        "n", "f0", "f1", F.coalesce("component", "rep").alias("component_id")), "class-components")
    out = marked.select("_id", "n", "f0", "f1").join(heads, ["n", "f0", "f1"], "left")
    return out.select(F.col("_id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, share: int = 80) -> DataFrame:
    """The documents that name their group: one of each, and all without shingles or without an id."""
    gone = grouped(docs, key, text, size, share).where(F.col(key) != F.col("component_id")).select(
        F.col(key).alias("__gone")).distinct()
    gone = staged(gone, "near-copies")
    # merged at every size: the copies grow with the corpus
    return docs.join(gone.hint("merge"), F.col(key) == F.col("__gone"), "left_anti")

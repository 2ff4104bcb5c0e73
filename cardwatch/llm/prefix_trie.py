"""The trie of conversations' prefixes, as node tables of flat arrays under a minimal perfect hash.

A node stands for the distinct sequence of the first d turns (role, text) of one or more conversations, its members; the
root has no turn. Every conversation can be rebuilt first: its own first turns are replaced by those of a base conversation.

1. Turns become digests in the scan, and only those are sorted, numbered and joined; a sequence's digest is built from
   its turns' by an operation that is cumulative, so a conversation may be cut into segments of ``segment`` turns, each
   of which needs one number of those before. A conversation of a third of all turns is many segments.
2. Distinct digests are enumerated by one combined aggregation with their count and smallest member. It also compares
   the last turn and the parent of all rows of a digest, so two sequences never share a node unnoticed.
3. Each node is owned by its smallest member; the nodes a conversation owns are the end of its path. A shard holds whole
   segments of paths: it enumerates the digests it sees, gives each a slot of its node table by a minimal perfect hash,
   and verifies that the slot's digest is the one asked for. Counts of owned nodes are scattered into flat arrays by
   slot and added to the parents' slots from the deepest level up; later segments of a path arrive as one number.
   Every owned node is counted in one shard, and each shard adds it to all its ancestors there; what is missing are
   the shards of other members of these ancestors, so the shards' tables add up to the trie's: one more combined sum.
4. The ids of the members that end at a node are sorted by Spark and hashed as they stream past.

Tasks hold about ``shard_rows`` rows and one segment. Only the digest of the ids that end at one node is computed by one
task, by definition, in a stream of ids.

Defined cases: rows without a conversation id are left out; a null turn comes first, rows of equal turn are ordered by role
and then by the SHA-256 of role and text; null roles and texts are empty; a base without rows has no turns; an empty
table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import words as W
from cardwatch.llm.mixing import n_words
from cardwatch.llm.work import discard, numbered, staged

PATH, NODE, LATER, TOP = range(4)
SUMS, OWNED = ["_lo", "_hi", "_leaves", "_saved", "_children"], ["_owner", "_depth", "_members", "_above"]
EMPTY = hashlib.sha256(b"").hexdigest()


class PerfectHash:
    """A bijection from distinct keys (lo, hi) to 0..n-1: level by level, keys that are alone in their place stay."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.lo, self.hi = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        left, placed = np.arange(len(lo)), 0
        while len(left):
            at = self._place(lo[left], hi[left], len(self.levels), max(8, 2 * len(left)))
            taken = np.bincount(at, minlength=max(8, 2 * len(left))) == 1
            rank = placed + np.cumsum(taken) - taken
            self.levels.append((taken, rank))
            placed += int(taken.sum())
            left = left[~taken[at]]
            if len(self.levels) > 64:
                raise ValueError("equal keys have no slots of their own")
        self.lo[self._find(lo, hi)] = lo
        self.hi[self._find(lo, hi)] = hi
        self.slots(lo, hi)

    @staticmethod
    def _place(lo: np.ndarray, hi: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))
        key = W.mixed(lo.view(np.uint64) + salt) ^ hi.view(np.uint64)
        return (W.mixed(key) % np.uint64(size)).astype(np.int64)

    def _find(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(lo), -1), np.arange(len(lo))
        for level, (taken, rank) in enumerate(self.levels):
            at = self._place(lo[left], hi[left], level, len(taken))
            slot[left[taken[at]]] = rank[at[taken[at]]]
            left = left[~taken[at]]
        return slot

    def slots(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Slots of keys of the set, verified against the keys that the slots belong to."""
        slot = self._find(lo, hi)
        if (slot < 0).any() or (self.lo[slot] != lo).any() or (self.hi[slot] != hi).any():
            raise ValueError("a slot does not belong to its key")
        return slot


def gathered(rows: dict[str, np.ndarray], segment: int) -> dict[str, np.ndarray]:
    """The node table of one shard: sums over each node's subtree of what the shard's members own."""
    path = rows["_kind"] == PATH
    at = np.cumsum(path) - 1  # the path row that a row belongs to
    lo, hi = rows["_lo"][path], rows["_hi"][path]
    known = PerfectHash(*W.distinct(lo, hi))
    slot, n = known.slots(lo, hi), len(known.lo)
    level = np.zeros(n, np.int64)
    level[slot] = rows["_depth"][path] % segment
    parent = np.full(n, -1)
    inner = np.flatnonzero(rows["_depth"][path] % segment > 0)
    parent[slot[inner]] = slot[inner - 1]
    leaves, saved, children = (np.zeros(n, np.int64) for _ in range(3))
    own, later = rows["_kind"] == NODE, rows["_kind"] == LATER
    for kind in (own, later):
        np.add.at(leaves, slot[at[kind]], rows["_leaves"][kind])
        np.add.at(saved, slot[at[kind]], rows["_saved"][kind])
    owned = slot[at[own]]
    np.add.at(children, parent[owned][parent[owned] >= 0], 1)
    order = np.argsort(-level, kind="stable")
    edges = np.flatnonzero(np.diff(level[order], prepend=-1))
    for start, stop in zip(edges, np.append(edges[1:], n)):
        here = order[start:stop]
        here = here[parent[here] >= 0]
        np.add.at(leaves, parent[here], leaves[here])
        np.add.at(saved, parent[here], saved[here])
    owner, depth, members, above = (np.full(n, -1) for _ in range(4))
    named = np.zeros(n, bool)
    named[owned] = True
    owner[owned], depth[owned] = rows["_conv"][own], rows["_depth"][own]
    members[owned] = rows["_members"][own]
    above[owned] = rows["_conv"][own]  # a node below an owned one has the same owner
    top = rows["_kind"] == TOP
    above[slot[at[top]]] = rows["_members"][top]
    # the first level of a segment has its parent elsewhere
    outside = own & (rows["_depth"] > 0) & (rows["_depth"] % segment == 0)
    rest = int(outside.sum())
    full = lambda x, value: np.concatenate((x, np.full(rest, value, x.dtype)))
    return {"_lo": np.concatenate((known.lo, rows["_plo"][outside])), "_hi": np.concatenate((known.hi, rows["_phi"][outside])),
            "_leaves": full(leaves, 0), "_saved": full(saved, 0), "_children": full(children, 1), "_named": full(named, False),
            "_owner": full(owner, 0), "_depth": full(depth, 0), "_members": full(members, 0), "_above": full(above, 0)}


def _sharded(shard_rows: int, segment: int):
    """Node tables of shards; rows come sorted by conversation, segment, depth and kind."""
    def table(kept: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = pa.Table.from_batches(kept)
        found = gathered({n: np.asarray(columns[n]) for n in columns.column_names}, segment)
        arrays = [pa.array(found[n]) for n in SUMS] + [pa.array(found[n], mask=~found["_named"]) for n in OWNED]
        return pa.RecordBatch.from_arrays(arrays, [*SUMS, *OWNED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for batch in batches:
            if rows >= shard_rows:
                whole = pa.Table.from_batches([*kept, batch])
                conv, part = np.asarray(whole["_conv"]), np.asarray(whole["_part"])
                edges = np.flatnonzero((conv[1:] != conv[:-1]) | (part[1:] != part[:-1])) + 1
                cut = int(edges[-1]) if len(edges) else 0
                if cut:
                    yield table(whole.slice(0, cut).to_batches())
                kept, rows = whole.slice(cut).to_batches(), whole.num_rows - cut
            else:
                kept.append(batch)
                rows += batch.num_rows
        if rows:
            yield table(kept)
    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids joined by commas; rows come sorted by node and id."""
    current, digest = None, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                           pa.array(columns[2], pa.string())], ["_lo", "_hi", "_ends"])

    for batch in batches:
        lo, hi, conv = (np.asarray(batch.column(c)) for c in ("_lo", "_hi", "_conv"))
        edges = np.flatnonzero(np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))[:len(lo)]
        done = []
        for start, stop in zip(edges.tolist(), np.append(edges[1:], len(lo)).tolist()):
            text = ",".join(map(str, conv[start:stop].tolist())).encode()
            node = (int(lo[start]), int(hi[start]))
            if node == current:
                digest.update(b"," + text)
            else:
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = node, hashlib.sha256(text)
        yield batch_of(done)
    if current is not None:
        yield batch_of([(*current, digest.hexdigest())])


def _numbered_turns(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(_conv, _d1, _d2, _words, _n): each turn's digest and words, with a number in the order of the conversations."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    sha = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("_conv"), F.col(turn).alias("_turn"), role.alias("_role"), text.alias("_text"), sha.alias("_sha"))
    # 60 + 60 bits of the digest: what a turn is known by from here on
    turns = turns.select("_conv", "_turn", "_role", "_sha", n_words("_text").alias("_words"),
                         *[F.conv(F.substring("_sha", at, 15), 16, 10).cast("bigint").alias(name) for at, name in ((1, "_d1"), (16, "_d2"))])
    turns = staged(turns, "turns")
    return numbered(turns, F.struct("_conv", "_turn", "_role", "_sha"), "_n", "turn-order").select("_conv", "_d1", "_d2", "_words", "_n")


def paths(conversations: DataFrame, base: Column, kept: Column, segment: int, key: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """Each prefix of each rebuilt conversation: (_conv, _part, _depth, _length, _words, _d1, _d2, _lo, _hi, _plo, _phi)."""
    turns = staged(_numbered_turns(conversations, key, turn, role, text), "numbered-turns")
    own = staged(turns.groupBy("_conv").agg(F.min("_n").alias("_first"), F.count("*").alias("_size")), "conversations")
    info = own.withColumn("_base", base).withColumn("_kept", kept).join(
        own.select(F.col("_conv").alias("_base"), F.col("_size").alias("_there")), "_base", "left")
    info = info.withColumn("_head", F.least("_kept", F.coalesce("_there", F.lit(0)))).withColumn(
        "_length", F.col("_head") + F.greatest(F.col("_size") - F.col("_kept"), F.lit(0)))
    info = staged(info.select("_conv", "_first", "_base", "_kept", "_head", "_length"), "lengths")
    placed = turns.join(info, "_conv").withColumn("_at", F.col("_n") - F.col("_first"))
    longest = info.agg(F.coalesce(F.max("_head"), F.lit(0))).first()[0]
    tail = placed.where("_at >= _kept").select(
        "_conv", (F.col("_head") + F.col("_at") - F.col("_kept") + 1).alias("_depth"), "_length", "_words", "_d1", "_d2")
    follow = info.select(F.col("_conv").alias("_to"), F.col("_base").alias("_of"), F.col("_head").alias("_take"),
                         F.col("_length").alias("_long"))
    head = placed.where(F.col("_at") < longest).join(
        follow, (F.col("_conv") == F.col("_of")) & (F.col("_at") < F.col("_take"))).select(
        F.col("_to").alias("_conv"), (F.col("_at") + 1).alias("_depth"), F.col("_long").alias("_length"), "_words", "_d1", "_d2")
    root = info.select("_conv", F.lit(0).cast("bigint").alias("_depth"), "_length",
                       *[F.lit(0).cast("bigint").alias(c) for c in ("_words", "_d1", "_d2")])
    rows = tail.union(head).union(root).withColumn("_part", F.floor(F.col("_depth") / segment).cast("bigint"))
    nothing = F.lit(0).cast("bigint")
    terms = {"_a": F.xxhash64("_depth", "_d1", "_d2"), "_b": F.xxhash64(F.lit("second"), "_d2", "_d1", "_depth")}
    for name, term in terms.items():
        rows = rows.withColumn(name, F.when(F.col("_depth") > 0, term).otherwise(nothing))
    rows = staged(rows, "path-turns")
    # conversations of several segments: what stands before each segment
    parts = rows.where(F.col("_length") >= segment).groupBy("_conv", "_part").agg(F.bit_xor("_a").alias("_a"), F.bit_xor("_b").alias("_b"))
    before = "over (partition by _conv order by _part rows between unbounded preceding and 1 preceding)"
    carried = staged(parts.select("_conv", "_part", F.expr(f"bit_xor(_a) {before}").alias("_ca"),
                                  F.expr(f"bit_xor(_b) {before}").alias("_cb")).where("_part > 0"), "carried")
    so_far = "over (partition by _conv, _part order by _depth rows between unbounded preceding and current row)"
    found = rows.join(carried, ["_conv", "_part"], "left")
    for lane, term, carry in (("lo", "_a", "_ca"), ("hi", "_b", "_cb")):
        found = found.withColumn(f"_{lane}", F.expr(f"bit_xor({term}) {so_far}").bitwiseXOR(F.coalesce(carry, nothing)))
        found = found.withColumn(f"_p{lane}", F.col(f"_{lane}").bitwiseXOR(F.col(term)))
    found = staged(found.select("_conv", "_part", "_depth", "_length", "_words", "_d1", "_d2", "_lo", "_hi", "_plo", "_phi"), "paths")
    discard(turns, own, info, rows, carried)
    return found


def trie(conversations: DataFrame, base: Column | None = None, kept: Column | None = None, key: str = "conv_id",
         turn: str = "turn", role: str = "role", text: str = "text", segment: int = 4096,
         shard_rows: int = 1 << 17) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The first ``kept`` turns of the conversation ``base`` (columns over _conv) replace as many own ones; without them
    conversations stay as they are. Ids are whole numbers.
    """
    base, kept = (F.col("_conv") if base is None else base), (F.lit(0) if kept is None else kept)
    rows = paths(conversations, base.cast("bigint"), kept.cast("bigint"), segment, key, turn, role, text)
    checked = ["_depth", "_d1", "_d2", "_plo", "_phi"]
    nodes = rows.groupBy("_lo", "_hi").agg(
        F.min("_conv").alias("_owner"), F.count("*").alias("_members"), F.max("_length").alias("_longest"),
        F.max("_words").alias("_words"), *[F.min(c).alias(c) for c in checked], *[F.max(c).alias(f"{c}_") for c in checked])
    alike = F.lit(True)
    for c in checked:
        alike = alike & (F.col(c) == F.col(f"{c}_"))
    nodes = nodes.select(
        "_lo", "_hi", F.when(alike, F.col("_owner")).otherwise(F.raise_error(F.lit("two sequences have one digest")).cast("bigint")).alias("_owner"),
        "_depth", "_plo", "_phi", "_members", (F.col("_longest") == F.col("_depth")).cast("bigint").alias("_leaves"),
        ((F.col("_members") - 1) * F.col("_words")).alias("_saved"), F.floor(F.col("_depth") / segment).cast("bigint").alias("_part"))
    nodes = staged(nodes, "nodes")

    none = F.lit(0).cast("bigint")

    def given(frame: DataFrame, kind: int, **columns: Column) -> DataFrame:
        names = ["_lo", "_hi", "_plo", "_phi", "_leaves", "_saved", "_members"]
        return frame.select("_conv", "_part", "_depth", F.lit(kind).alias("_kind"), *[columns.get(n, none).alias(n) for n in names])

    kept_of = lambda *names: {n: F.col(n) for n in names}
    owned = nodes.withColumnRenamed("_owner", "_conv")
    # the first node that a conversation owns hangs below another's
    tops = staged(nodes.groupBy(F.col("_owner").alias("_conv")).agg(
        F.min(F.struct("_depth", "_part", F.col("_plo").alias("_of"), F.col("_phi").alias("_and"))).alias("t"))
        .select("_conv", "t.*").where("_depth > 0"), "tops")
    root = nodes.where("_depth = 0").select("_owner").first()
    above = nodes.select(F.col("_lo").alias("_of"), F.col("_hi").alias("_and"), F.col("_owner").alias("_members"))
    tops = tops.where("_depth > 1").join(above, ["_of", "_and"]).select("_conv", "_part", "_depth", "_members").union(
        tops.where("_depth = 1").select("_conv", "_part", "_depth", F.lit(root[0] if root else None).cast("bigint")))
    # what later segments own, for the last row of each segment
    sums = nodes.where("_part > 0").groupBy(F.col("_owner").alias("_conv"), "_part").agg(
        F.sum("_leaves").alias("_leaves"), F.sum("_saved").alias("_saved"))
    after = "over (partition by _conv order by _part desc rows between unbounded preceding and 1 preceding)"
    later = rows.where(F.col("_length") >= segment).groupBy("_conv", "_part").agg(F.max("_depth").alias("_depth")).join(
        sums, ["_conv", "_part"], "left").select("_conv", "_part", "_depth", F.expr(f"sum(_leaves) {after}").alias("_leaves"),
                                                 F.expr(f"sum(_saved) {after}").alias("_saved")).where("_leaves is not null")
    together = given(rows, PATH, **kept_of("_lo", "_hi", "_plo", "_phi")).union(
        given(owned, NODE, **kept_of("_plo", "_phi", "_leaves", "_saved", "_members"))).union(
        given(later, LATER, **kept_of("_leaves", "_saved"))).union(given(tops, TOP, **kept_of("_members")))
    names = [*SUMS, *OWNED]
    tables = together.repartition("_conv", "_part").sortWithinPartitions("_conv", "_part", "_depth", "_kind").mapInArrow(
        _sharded(shard_rows, segment), T.StructType([T.StructField(n, T.LongType()) for n in names]))
    ends = rows.where("_depth = _length").select("_lo", "_hi", "_conv").repartition("_lo", "_hi").sortWithinPartitions(
        "_lo", "_hi", "_conv").mapInArrow(_ends, T.StructType([
            T.StructField("_lo", T.LongType()), T.StructField("_hi", T.LongType()), T.StructField("_ends", T.StringType())]))
    every = tables.withColumn("_ends", F.lit(None).cast("string")).unionByName(ends, allowMissingColumns=True)
    out = every.groupBy("_lo", "_hi").agg(
        *[F.sum(c).alias(c) for c in SUMS[2:]], *[F.max(c).alias(c) for c in OWNED], F.max("_ends").alias("_ends"))
    return out.select(
        F.col("_owner").alias("conv_id"), F.col("_depth").alias("depth"),
        F.when(F.col("_depth") > 0, F.col("_above")).alias("parent_conv_id"), F.col("_members").alias("n_convs"),
        F.col("_children").alias("n_children"), F.col("_leaves").alias("n_leaves"), F.col("_saved").alias("saved_tokens"),
        F.coalesce("_ends", F.lit(EMPTY)).alias("ends_sha256"))

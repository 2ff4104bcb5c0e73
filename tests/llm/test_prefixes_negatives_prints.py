"""Operators 11 to 13 against brute force on rows that are easy to get wrong."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cardwatch.llm import hard_negatives, prefix_trie, simhash

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


# 11 prefixes

def trie_by_hand(rows, base, kept):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, role, sha), (role, text)))
    plain = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    built = {c: plain.get(base(c), [])[:kept(c)] + ts[kept(c):] for c, ts in plain.items()}
    members = collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(SPACES.findall(n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(node))
        out.add((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string, _conv int, depth string, _n int"


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"say {rng.randrange(3)} now") for c in range(-25, 60)
            for t in range(rng.randrange(0, 7)) if rng.random() < 0.9]
    rows += [(c, t, "user", f"same {t}") for c in (100, 101, 140, 200) for t in range(23)]
    rows += [(201, t, "user", f"same {t}" if t < 17 else f"other {t}") for t in range(40)]
    rows += [(300, None, None, None), (300, None, "a", "b c"), (300, 1, "", "x"), (301, 5, "a", ""), (301, 5, "", "a"),
             (301, 5, "a", ""), (None, 1, "user", "lost"), (None, None, None, None), (302, 0, "user", "long " * 50_000)]
    return rows


@pytest.mark.parametrize("segment,shard_rows", [(4096, 1 << 17), (4, 10), (1, 3)])
def test_tries_equal_brute_force(spark, spoken, segment, shard_rows):
    rows = spark.createDataFrame([(*r, 1, "d", 2) for r in spoken], TURNS).repartition(3)
    conv = F.col("_conv")
    got = prefix_trie.trie(rows, conv - conv % 20, F.crc32(conv.cast("string")) % 4, segment=segment, shard_rows=shard_rows)
    expected = trie_by_hand(spoken, lambda c: c - int(math.fmod(c, 20)), lambda c: zlib.crc32(str(c).encode()) % 4)
    found = [tuple(r) for r in got.select(*NODE).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_conversations_as_they_are(spark, spoken):
    got = prefix_trie.trie(spark.createDataFrame([(*r, 1, "d", 2) for r in spoken], TURNS))
    assert {tuple(r) for r in got.select(*NODE).collect()} == trie_by_hand(spoken, lambda c: c, lambda c: 0)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(empty).collect() == []


def test_slots_are_a_bijection_and_strange_keys_are_noticed():
    rng = np.random.default_rng(0)
    lo, hi = rng.integers(-2**63, 2**63 - 1, (2, 5000))
    lo[:40] = 7
    known = prefix_trie.PerfectHash(lo, hi)
    assert sorted(known.slots(lo, hi)) == list(range(5000))
    with pytest.raises(ValueError):
        known.slots(np.array([1]), np.array([2]))
    with pytest.raises(ValueError):
        prefix_trie.PerfectHash(np.array([1, 1]), np.array([2, 2]))
    assert not len(prefix_trie.PerfectHash(lo[:0], hi[:0]).slots(lo[:0], hi[:0]))


# 12 hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int, _id string, _row int, score double"


def negatives_by_hand(rows, is_anchor, positives=5, k=3, least=50, most=95):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows
            if None not in (i, v, c) and all(x is not None and math.isfinite(x) for x in v)]
    out = collections.Counter()
    for a, (anchor, v, own) in enumerate(good):
        if not is_anchor(anchor):
            continue
        scored = [(-sum(map(lambda x, y: x * y, v, w)), i, c) for b, (i, w, c) in enumerate(good) if b != a and len(w) == len(v)]
        for score, positive, _ in sorted(r for r in scored if r[2] == own)[:positives]:
            inside = sorted(r for r in scored if r[2] != own and least * -score <= 100 * -r[0] <= most * -score)
            for rank, (other, negative, _) in enumerate(inside[:k], 1):
                out[anchor, positive, rank, negative, -score, -other] += 1
    return out


MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)], int(rng.integers(0, 4))) for i in range(300)]
    rows += [(i, [0.5] * 6, i % 3) for i in range(300, 360)]  # ties
    rows += [(400, None, 1), (450, [1.0] * 5 + [None], 1), (500, [1.0] * 5 + [float("nan")], 1), (550, [float("inf")] * 6, 1),
             (600, [1.0] * 6, None), (None, [1.0] * 6, 1), (650, [0.0] * 6, 2), (651, [0.0] * 6, 3), (700, [], 1), (701, [], 1),
             (702, [], 2), (750, [3.0, 1.0], 1), (751, [2.0, 1.0], 1), (752, [2.0, 0.5], 2), (800, [9.0] * 8, 1),
             (310, [0.4] * 6, 2), (350, [0.5] * 6, 2)]
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 25, 2000])
def test_negatives_equal_brute_force(spark, vectors, block_bytes):
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in vectors], VECTORS).repartition(3)
    got = hard_negatives.mine(frame, F.col("_id") % 50 == 0, block_bytes=block_bytes)
    expected = negatives_by_hand(vectors, lambda i: i % 50 == 0)
    assert expected and collections.Counter(tuple(r) for r in got.select(*MINED).collect()) == expected


def test_other_windows_and_numbers_of_rows(spark, vectors):
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in vectors], VECTORS)
    got = hard_negatives.mine(frame, F.col("_id") % 30 == 0, positives=9, k=2, least=10, most=100)
    assert collections.Counter(tuple(r) for r in got.select(*MINED).collect()) == negatives_by_hand(
        vectors, lambda i: i % 30 == 0, 9, 2, 10, 100)


def test_no_vectors_and_huge_ones(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECTORS), F.col("_id") % 2 == 0).collect() == []
    big = spark.createDataFrame([(0, [3e38, 1.0], 1), (1, [3e38, 1.0], 1), (2, [3e38, 0.0], 2)],
                                "vec_id bigint, embedding array<double>, label int")
    # the positive's score is the end of the range, and so is the other's: above 95 %
    assert hard_negatives.mine(big, F.col("_id") == 0).collect() == []
    assert hard_negatives.mine(big, F.col("_id") == 0, most=100).count() == 1


def test_scores_are_exact():
    rng = np.random.default_rng(4)
    for size in (2**20, 2**40):
        a, b = (rng.integers(-size, size, (5, 7)).astype(float) for _ in range(2))
        exact = [[max(-2**63, min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in b] for p in a]
        assert hard_negatives.products(a, b).tolist() == exact


# 13 fingerprints

def print_by_hand(text, size=3):
    words = SPACES.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [words[i:i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] if words else []
    ones = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(" ".join(run).encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(runs))


def components_by_hand(prints):
    """prints: (id, fingerprint) pairs."""
    parent = {i: i for i, _ in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, x), (b, y) in itertools.combinations(prints, 2):
        if (x ^ y).bit_count() <= 3:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: find(i) for i in parent}


DOCS = "doc_id bigint, text string, _id int, rep string, a string, _print int"


def test_prints_and_components_equal_brute_force(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(500)}"
    texts = [" ".join(word() for _ in range(rng.choice([1, 2, 3, 4, 30, 300]))) for _ in range(80)]
    for base in list(texts[:20]):
        for _ in range(5):
            other = base.split()
            other[rng.randrange(len(other))] = word()
            texts.append("  ".join(other).upper() if rng.random() < 0.3 else "\n".join(other))
    texts += [None, "", " \t", "É é ÀB", "x" * 200_000, " ".join(word() for _ in range(100_000)), texts[3], texts[4]]
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    rows += [(rows[5][0], texts[40]), (rows[5][0], texts[5]), (None, texts[5]), (None, None)]
    got = simhash.grouped(spark.createDataFrame([(*r, 1, "r", "a", 2) for r in rows], DOCS).repartition(3), shard_rows=16)
    by_id = components_by_hand([(i, print_by_hand(t)) for i, t in rows if i is not None])
    expected = collections.Counter((i, f"{print_by_hand(t):016x}", by_id.get(i)) for i, t in rows)
    assert collections.Counter(tuple(r) for r in got.collect()) == expected


@pytest.mark.parametrize("shard_rows", [100, 1 << 15])
def test_dense_and_sparse_fingerprints(spark, shard_rows):
    rng = random.Random(shard_rows)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base) | {0, 1, 2**64 - 1, 2**63, 7, 15}
    for b in base[:6]:
        for _ in range(60):
            prints.add(b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(1, 7))))
    prints |= {(b ^ rng.getrandbits(6)) for b in base[:3] for _ in range(200)}  # dense
    rows = list(enumerate(sorted(prints, key=lambda x: x * 0x9E3779B97F4A7C15 % 2**64)))
    classes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x, i) for i, x in rows], "_print bigint, rep bigint")
    edges = [tuple(r) for r in simhash.linked(classes.repartition(4), 3, shard_rows).collect()]
    of = dict(rows)
    assert all((of[a] ^ of[b]).bit_count() <= 64 for a, b in edges) and len(edges) <= 8 * len(rows) ** 1.2
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    assert {i: find(i) for i in parent} == components_by_hand(rows)


def test_no_documents(spark):
    assert simhash.grouped(spark.createDataFrame([], DOCS)).collect() == []


def test_very_long_shingles():
    texts = ["a " * 300_000, "b", None, "é" * 100_000 + " c d e"]
    got = simhash.fingerprints(pa.array(texts), 3).tolist()
    assert got == [print_by_hand(t) for t in texts]

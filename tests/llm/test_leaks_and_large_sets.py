"""Names at the start of sentences, SQL on texts made for it, and near copies of large sets."""

import random
import re

import pytest

from cardwatch.llm import decontaminate, jaccard_join
from cardwatch.llm.queries import LEAKS_SQL
from compare import difference

ITEMS = [(1, "Alice has 3 apples and buys 5 more today"), (2, "What is the capital of France"), (3, "one two three four"),
         (4, "A train leaves Paris at 5 and arrives in Lyon after 3 hours of travel through the hills."), (5, None), (6, ""),
         (7, "How many days does Carol need if Carol reads 9 pages of the long book every evening before dinner")]
DOCS = [(1, "Question: Bob has 7 apples and buys 2 more today"), (2, "Quiz. Bob has 7 apples and buys 2 more today"),
        (3, "This is the capital of Spain and nothing else is said of it here"), (4, "and one two three four"),
        (5, "so WHAT IS THE CAPITAL OF FRANCE, they asked"), (6, None), (7, ""),
        (8, "Then. A train leaves Berlin at 8 and arrives in Bonn after 2 hours of travel through the hills, really."),
        (9, "How many days does Dave need if Erin reads 4 pages of the long book every evening before dinner"),
        (10, "How many days does Dave need if Dave reads 4 pages of the long book every evening before dinner"),
        (11, "alice has 3 apples and buys 5 more today"), (12, "Nothing to see here at all, it is a quiet day in May")]


def test_first_words_may_be_names_and_sql_agrees(spark):
    import duckdb
    docs = spark.createDataFrame([(*d, i) for i, d in enumerate(DOCS)], "doc_id bigint, text string, _id int")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.leaks(docs, items)
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(1, 1), (2, 1), (5, 2), (8, 4), (10, 7), (11, 1)}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", DOCS)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", ITEMS)
    assert difference(con, LEAKS_SQL, found) is None


@pytest.mark.parametrize("share,sizes", [(80, (700, 930, 1500)), (90, (1500, 2000, 2600))])
def test_near_copies_of_large_sets_equal_brute_force(spark, share, sizes):
    rng = random.Random(share)
    texts = []
    passage = [f"p{i}" for i in range(100)]
    for n in sizes:
        base = [f"{n}w{i}" for i in range(n)]
        texts.append(base)
        for _ in range(8):
            other = list(base)
            for _ in range(rng.randrange(1, int(n * (100 - share) / 220))):
                at = rng.randrange(len(other))
                if rng.random() < 0.5:
                    other[at] = f"x{rng.random()}"
                else:
                    other.insert(at, f"y{rng.random()}")
            texts.append(other)
        texts.append(passage + [f"{n}z{i}" for i in range(n)])
    texts.append(passage * 30)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in jaccard_join.grouped(
        spark.createDataFrame(rows, "doc_id bigint, text string"), size=2, share=share).collect()}
    sets = [{tuple(t[i:i + 2]) for i in range(len(t) - 1)} for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    linked = 0
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
                linked += 1
    assert linked > 20 and got == {i: find(i) for i in range(len(texts))}

"""Every operator on rows that are easy to get wrong, and against brute force where SQL has no answer."""

import collections
import html
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from cardwatch.llm import (components, decontaminate, dom, html_text, jaccard_join, line_templates, mixing, neighbours,
                           quality, substring, suffixes, warc, words)
from cardwatch.llm.queries import ORACLES, QUERIES
from compare import connect, difference

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n int, key string, rep string, "
             "size string, target string, whole int, label int, component string, _id int, _text string")
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n, stock=2000):
    return " ".join(f"w{rng.randrange(stock)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """id -> text; several rows have odd ids or texts."""
    rng = random.Random(3)
    long = sentence(rng, 40_000, 10**6)
    base, passage = sentence(rng, 300), sentence(rng, 70)
    edited = base.split()
    edited[150] = "changed"
    rows = [(i, "\n".join(sentence(rng, 12) for _ in range(rng.randrange(1, 9)))) for i in range(40)]
    rows += [(100 + i, f"{sentence(rng, 30)}\n{passage} {sentence(rng, 30)}\nSubscribe to issue {i} of our weekly letter today")
             for i in range(8)]
    rows += [(200, base), (201, " ".join(edited)), (202, base), (203, base.upper()), (210, None), (211, ""), (212, " \n\t "),
             (213, "one"), (214, "one two"), (215, "One TWO"), (None, base), (None, None), (216, long), (217, long),
             (200, base), (218, "x" * 300_000), (219, "é " * 20 + base)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", [None, "a", "b", "ä", "c"][k % 5], len(t or ""), k, "k", "r", "s", "t", k, 1, "c", k, "x")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert difference(connect(SMALL), ORACLES[name], QUERIES[name](spark, SMALL)) is None


def test_all_queries_are_there():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(QUERIES, key=lambda n: int(re.findall(r"\d+", n)[0]))] == list(range(1, 14))


# words

def test_words_and_windows_equal_plain_python():
    import pyarrow as pa
    given = [None, "", " a  b c\td ", "e", "\n", "A b c d", "a b c d" * 3]
    found = words.split(pa.array(given, pa.string()), lower=True)
    expected = [SPACES.findall((t or "").lower()) for t in given]
    data = found.data.tobytes()
    own = [[data[s:e].decode() for s, e in zip(found.start[a:b], found.end[a:b])] for a, b in zip(found.first, found.first[1:])]
    assert own == expected
    at, grams = found.grams(2)
    pairs = {}
    flat = [w for t in expected for w in t]
    for i, g in zip(at, grams):
        assert pairs.setdefault(g, (flat[i], flat[i + 1])) == (flat[i], flat[i + 1])
    assert len(pairs) == len({p for t in expected for p in zip(t, t[1:])})
    keep = np.array([w != "b" for w in flat])
    assert words.joined(found, keep).to_pylist() == [" ".join(w for w in t if w != "b") for t in expected]


def test_every_window_of_a_text_holds_its_minimiser():
    rng = np.random.default_rng(1)
    text = np.repeat([0, 1, 2], [30, 3, 17])
    grams = rng.integers(0, 9, 50).astype(np.uint64)
    best, whole = words.window_best(np.arange(50), grams, text, 5)
    for i in range(50):
        inside = [j for j in range(i, i + 5) if j < 50 and text[j] == text[i]]
        assert best[i] == min(inside, key=lambda j: (grams[j], j))
        assert whole[i] == (len(inside) == 5 or (text[i] == 1 and i == 30))


# 1 lines

def test_lines_recur_across_documents(docs, texts):
    got = {(r.doc_id, r.n): r for r in line_templates.drop_recurring(docs).collect()}
    assert len(got) == len(texts)
    for k, (i, text) in enumerate(texts):
        row = got[i, k]
        if i is not None and 100 <= i < 108:
            assert ("Subscribe" in row.text) == (i == 100) and row.n_dropped == (i != 100)
        else:
            assert row.text == text and row.n_dropped == 0


def test_lines_of_an_empty_table(nothing):
    assert line_templates.drop_recurring(nothing).count() == 0


def test_varying_fields_belong_to_the_main_template(spark):
    rows = [(i, f"Posted by the author named {c} at noon in the main square") for i, c in enumerate("aaaaaabcdef")]
    rows += [(20, "Posted by the quick fox who jumps over all the lazy dogs")]
    got = dict(line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id int, text string")).select("doc_id", "text").collect())
    assert [i for i, t in sorted(got.items()) if t] == [0, 20]


# 2 mixing

def test_mixing_comes_near_its_targets(docs, nothing, texts):
    mixed = mixing.mix(docs, mixing.n_words("text"))
    rows = mixed.collect()
    assert len(rows) == len(texts) and rows and mixing.mix(nothing, mixing.n_words("text")).count() == 0
    taken, target, longest, size = collections.Counter(), {}, collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len(SPACES.findall(r.text or "")) and r.taken == r.size * r.repeats and r.repeats <= 3
        taken[r.source] += r.taken
        size[r.source] += r.size
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
    for source, aim in target.items():
        assert aim <= 3 * size[source] + 1e-6
        assert abs(taken[source] - aim) <= 2 * longest[source]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-3
    again = mixing.mix(docs.repartition(7), mixing.n_words("text"))
    assert sorted((r.n, r.taken) for r in again.collect()) == sorted((r.n, r.taken) for r in rows)


def test_given_weights_and_a_source_without_one(spark):
    rows = spark.range(200).selectExpr("id", "if(id < 20, 'small', if(id < 100, 'mid', 'none')) as source")
    weights = spark.createDataFrame([("small", 9), ("mid", 1)], "source string, weight int")
    got = dict(mixing.mix(rows, F.lit(10), key="id", weights=weights).groupBy("source").agg(F.sum("taken")).collect())
    assert got["small"] == 600 and got["none"] == 0 and got["mid"] == 1400


def test_rows_of_one_key_or_none_are_parted_by_the_threshold(spark):
    rng = random.Random(8)
    rows = [(None, f"{sentence(rng, 9)} {i}", "a") for i in range(100)] + [(7, sentence(rng, 10), "c") for _ in range(50)]
    rows += [(i, sentence(rng, 10), "b") for i in range(100, 150)] + [(8, "ten " * 10, "d")] * 30
    table = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = mixing.mix(table.repartition(3), mixing.n_words("text"))
    taken, target = collections.Counter(), {}
    for r in got.collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 5 for s in "abc") and target["a"] not in (0, 1000, 2000, 3000)
    assert taken["d"] in (0, 300, 600, 900) and abs(taken["d"] - target["d"]) <= 150
    again = mixing.mix(table, mixing.n_words("text"))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


# 3 suffixes

def test_repeated_passages_are_found_and_nothing_else(docs, nothing, texts):
    by_id = collections.defaultdict(list)
    for i, t in texts:
        by_id[i].append(SPACES.findall(t or ""))
    found = suffixes.repeats(docs).collect()
    for r in found:
        own, kept = by_id[r.doc_id][0], by_id[r.kept_doc_id][0]
        span = own[r.start_word:r.end_word]
        assert r.kept_doc_id < r.doc_id and r.n_words == len(span) >= 50
        assert span == kept[r.kept_start_word:r.kept_start_word + len(span)]
    covered = collections.defaultdict(set)
    for r in found:
        covered[r.doc_id].update(range(r.start_word, r.end_word))
    seen = set()
    for i in sorted(x for x in by_id if x is not None):
        own = by_id[i][0]
        windows = {tuple(own[k:k + 50]): k for k in range(len(own) - 49)}
        expected = {p for w, k in windows.items() if w in seen for p in range(k, k + 50)}
        assert covered[i] == expected, i
        seen |= set(windows)
    assert suffixes.repeats(nothing).count() == 0


def test_a_shorter_match_of_the_neighbour_hides_no_passage(spark):
    rng = random.Random(8)
    passage = sentence(rng, 60, 10**6).split()
    pieces = [w for k in range(16) for w in [*passage[k:k + 45], f"x{k}"]]  # all 40 words in a row, never 50
    rows = [(i, " ".join(w)) for i, w in ((1, ["a", *passage, "b"]), (2, pieces), (3, ["c", "d", *passage, "e"]))]
    found = suffixes.repeats(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert [(r.doc_id, r.kept_doc_id, r.start_word, r.end_word, r.kept_start_word) for r in found] == [(3, 1, 2, 62, 1)]


# 4 pages

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class=top><a href=/>Home</a></header>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><div id="cookie-notice">We use cookies</div>%s
<aside class="sidebar"><p>Related things</p></aside><form><input name=q><button>Go</button></form>
<footer>&copy; Somebody</footer></body></html>"""
BODY = """<h1>A  title</h1><p>First &amp; best<br>line, with <a href=x>a link</a>.<p>Second&nbsp;one<script>var t="</p>";</script> ends.
<div class="ad">Buy!</div><!-- <p>no</p> --><ul><li>item a<li>item b</ul><div class="comments"><p>Great text, I agree!</p></div>"""


def test_main_text_of_made_pages(spark):
    rng = random.Random(5)
    rows, expected = [(None, None), (1, ""), (1, "just text"), (2, "<p>unclosed <b>x")], {}
    for i in range(10, 60):
        paragraphs = [sentence(rng, rng.randrange(1, 60)) + "." for _ in range(rng.randrange(1, 8))]
        mark = ["<article>%s</article>", "<main>%s</main>", "<article class=post>%s</article>"][i % 3]
        rows.append((i, PAGE % (mark % ("<h1>Head</h1>" + "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)))))
        expected[i] = "\n".join(["Head", *paragraphs])
    rows.append((99, PAGE % f"<article>{BODY}</article>"))
    expected[99] = "A title\nFirst & best line, with a link.\nSecond one ends.\nitem a\nitem b"
    pages = spark.createDataFrame([(i, h, "u", 1) for i, h in rows], "page_id int, html string, text string, label int")
    got = html_text.extracted(pages, html_text.train(pages)).collect()
    assert len(got) == len(rows) and got[0].label == 1
    assert {r.page_id: r.text for r in got if r.page_id in expected} == expected
    assert [r.text for r in got if r.page_id is None] == [""]


def test_without_marked_pages_or_any_page(spark):
    pages = spark.createDataFrame([(1, "<div>Some text</div><nav>Menu</nav>")], "page_id int, html string")
    assert html_text.extracted(pages, html_text.train(pages)).first().text == "Some text"
    assert html_text.extracted(pages.limit(0), html_text.train(pages.limit(0))).count() == 0


SUBJECTS = ("related-work meta-analysis form-and-content copyright-law search-algorithms share-prices comment-policy-history "
            "social-history tags-in-music menu-planning footer-anatomy alert-fatigue notice-periods ad-hoc-networks login-shells "
            "sponsored-research banner-years reply-times cookie-recipes advertising header-files modal-logic popup-books "
            "widget-factories dialog-systems overlay-networks navigation-at-sea newsletterGenre subscribe-press meta-ethics").split()


def test_sections_named_after_a_subject_stay_and_side_matter_goes(spark):
    rng = random.Random(6)
    spoken = [f"{sentence(rng, 14)}. {sentence(rng, 9)}, {sentence(rng, 8)}." for _ in range(400)]
    pages = [(i, PAGE % ("<article><h1>Head</h1>%s</article>" % "".join(f"<p>{s}</p>" for s in rng.sample(spoken, 5))))
             for i in range(60)]
    expected = {}
    for i, name in enumerate(SUBJECTS, 1000):
        first, own, last = rng.sample(spoken, 3)
        pages.append((i, PAGE % f'<article><h1>Head</h1><p>{first}</p><section id="{name}"><h2>Part</h2><p>{own}</p></section><p>{last}</p></article>'))
        expected[i] = "\n".join(["Head", first, "Part", own, last])
    for i, name in enumerate(("site-footer", "share-buttons", "relatedPosts", "post-comments", "sidebar left", "cookie-notice"), 2000):
        first, own, last = rng.sample(spoken, 3)
        pages.append((i, PAGE % f'<article><h1>Head</h1><p>{first}</p><div class="{name}"><p>{own}</p></div><p>{last}</p></article>'))
        expected[i] = "\n".join(["Head", first, last])
    table = spark.createDataFrame(pages, "page_id int, html string")
    got = {r.page_id: r.text for r in html_text.extracted(table, html_text.train(table)).collect()}
    assert {i: got[i] for i in expected} == expected


def test_decoding_finds_the_most_probable_consistent_choice():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(2, 8)
        page = dom.Page("")
        page.parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        chance = [rng.uniform(0.02, 0.98) for _ in range(n)]

        def worth(states):
            total = 0.0
            for i, s in enumerate(states):
                before = states[page.parent[i]] if i else 0
                if s < before or s > before + 1:
                    return -np.inf
                total += np.log(chance[i] if s == 1 else 1 - chance[i]) - (2.0 if before == 1 and s == 2 else 0)
            return total

        best = max(itertools.product((0, 1, 2), repeat=n), key=worth)
        assert page.decoded(chance) == [s == 1 for s in best]


def test_a_cut_is_never_undone_below():
    page = dom.Page("<article><div><p>a</p><div><p>b</p></div></div></article>")
    keep = page.decoded([0.01, 0.9, 0.9, 0.9, 0.001, 0.9])
    assert keep == [False, True, True, True, False, False]


def test_controls_have_no_text_and_unclosed_ones_hide_nothing():
    assert dom.Page("<p>a<button>Share</button> b<select><option>x</select> c").text([True] * 2) == "a b c"
    assert dom.Page("<p>a<button>b c").text([True] * 2) == "ab c"
    assert dom.Page("<p>a<script>b").text([True] * 2) == "a"


@pytest.mark.parametrize("markup, expected", [
    ("<p>a<svg class=icon /> b</p><p>c", "a b\nc"), ("<p>a <svg/>b</p><p>c<svg><path d=x /></svg>", "a b\nc"),
    ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> b", "a x=1 b"), ("<p>a<math/> b", "a b"),
    ("<p>a<object data=x>no</p><p>b</p><p>c<object>no</object>", "a\nb\nc"), ("<p>a<video src=x>no<p>b<p>c", "a\nb\nc"),
    ("<div>a<object><p>no</p></object> b</div>", "a b"), ("<p>a<canvas>no<script>'</p>'</script>no</canvas>b", "ab")])
def test_foreign_and_unclosed_elements_hide_no_text_behind_them(markup, expected):
    page = dom.Page(markup)
    assert page.text([True] * len(page.tag)) == expected


def test_very_many_unclosed_elements():
    assert dom.Page("<div>" + "<svg>x" * 5000 + "</div>" + "<svg>y" * 5000 + "<p>z</svg>").features()


def test_very_long_and_broken_markup():
    assert dom.Page("<p " + "a='" * 50_000).text([True]) is not None
    assert dom.Page("<div>" * 3000 + "x").features()[-1][4] == 3000


# 5 neighbours

def test_recall_and_ranking(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((30, 16))
    data = [(i, (centre[i % 30] + 0.3 * rng.standard_normal(16)).tolist()) for i in range(3000)]
    data += [(3000 + i, data[20][1]) for i in range(400)]
    bad = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] * 16), (5080, [1.0]), (None, data[0][1]),
           (5100, [float("inf")] + [1.0] * 15)]
    table = spark.createDataFrame([(i, v, "x") for i, v in data + bad], "vec_id bigint, embedding array<double>, rank string")
    got = neighbours.nearest(table, F.col("_id") % 20 == 0, k=20, block_rows=256).collect()
    x, ids = np.array([v for _, v in data]), np.array([i for i, _ in data])
    by_query = collections.defaultdict(list)
    for r in got:
        by_query[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(by_query) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, rows in by_query.items():
        rows.sort()
        own = (x * x[ids == q]).sum(-1)
        own[ids == q] = -np.inf
        best = np.lexsort((ids, -own))[:20]
        assert [r[0] for r in rows] == list(range(1, 21))
        assert all(abs(s - own[ids == v][0]) < 1e-12 for _, v, s in rows)
        hits += len({v for _, v, _ in rows} & set(ids[best].tolist()))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
    assert hits / (20 * len(by_query)) >= 0.9


def test_few_or_no_vectors(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0]), (7, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    got = neighbours.nearest(one, F.col("_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 20), (0, 2, 7), (20, 1, 0), (20, 2, 7)]
    assert neighbours.nearest(one.limit(0), F.col("_id") % 20 == 0).count() == 0


def test_one_longer_vector_removes_no_other(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (7, [1.0, 1.0]), (40, [9.0, 9.0, 9.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(table, F.col("_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 20), (0, 2, 7), (20, 1, 0), (20, 2, 7)]


def test_each_length_is_searched_on_its_own_and_slices_of_queries_change_nothing(spark):
    rng = np.random.default_rng(5)
    by_length = {8: range(0, 900), 5: range(900, 1300), 3: range(1300, 1310)}
    data = {i: rng.standard_normal(n) for n, ids in by_length.items() for i in ids}
    data |= {2000 + i: data[40] for i in range(60)}  # copies: ties of score across blocks
    table = spark.createDataFrame([(i, v.tolist()) for i, v in data.items()], "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(table, F.col("_id") % 20 == 0, k=5, block_rows=128, confidence=0.999999)
    sliced = neighbours.nearest(table, F.col("_id") % 20 == 0, k=5, block_rows=128, confidence=0.999999, block_queries=7)
    rows = sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())
    assert rows == sorted(tuple(r) for r in sliced.select("query_id", "rank", "vec_id", "score").collect())
    want = []
    for q in (i for i in data if i % 20 == 0):
        scores = sorted((-float((data[q] * v).sum()), i) for i, v in data.items() if i != q and len(v) == len(data[q]))
        want += [(q, n + 1, i) for n, (_, i) in enumerate(scores[:5])]
    assert [r[:3] for r in rows] == sorted(want)


# 6 benchmark

ITEM = "A train leaves Paris at 14 with Alice on board and travels for 3 hours at 120 km before Alice meets Bob in Rome"


def test_other_numbers_and_names_are_found_inconsistent_ones_not(spark, docs, nothing):
    other = ITEM.replace("Alice", "Carol").replace("14", "9").replace("120", "95")
    mismatch = other.replace("before Carol", "before Dave")
    rows = [(1, f"Words before. {ITEM}. And after."), (2, f"So: {other}!"), (3, f"So: {mismatch}!"), (4, ITEM.upper()),
            (5, "A train leaves early"), (None, ITEM), (6, None), (7, "")]
    table = spark.createDataFrame(rows, "doc_id int, text string").withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame([(10, ITEM), (11, None), (12, "two words"), (13, "seven plain words make one short item")],
                                  "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table, items).collect()}
    assert {(1, 10), (2, 10), (None, 10)} <= got and not {d for d, _ in got} & {3, 5, 6, 7}
    left = {r.doc_id for r in decontaminate.clean(table, items).collect()}
    assert left == {3, 4, 5, 6, 7} - {d for d, _ in got}
    assert decontaminate.leaks(docs, items).count() == 0 and decontaminate.clean(nothing, items).count() == 0
    assert decontaminate.leaks(table, items.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "There seven plain words make one short item, yes")], "doc_id int, text string")
    assert [r.item_id for r in decontaminate.leaks(short, items).collect()] == [13]


def test_one_edit_hides_no_verbatim_words_and_values_may_coincide(spark):
    item = "If a farmer sells 3 baskets of apples and 5 baskets of pears then how many baskets were sold in the market"
    rows = [(1, ITEM.replace("before Alice", "before Dave")), (2, item.replace("3", "4").replace("5", "4")),
            (3, ITEM.replace("Alice", "Carol").replace("before Carol", "before Dave"))]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    items = spark.createDataFrame([(10, ITEM), (11, item)], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.n_covered for r in decontaminate.leaks(table, items).collect()}
    assert got == {(1, 10): 19, (2, 11): 22}


def test_verbatim_items_are_found_whatever_is_a_name(spark):
    short, sums = "Which planet is the largest one of all", "1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    rows = [(1, f"Question: {short}?"), (2, f"so {short.lower()}"), (3, f"Table {sums} end"), (4, ITEM.upper()),
            (5, "Which planet is the largest one"), (6, sums.replace("7", "70"))]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    items = spark.createDataFrame([(10, short), (11, sums), (12, ITEM)], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.n_covered for r in decontaminate.leaks(table, items).collect()}
    assert got == {(1, 10): 8, (2, 10): 8, (3, 11): 14, (4, 12): 24}


# 7 near copies

def brute_components(rows, size, share):
    sets = []
    for _, t in rows:
        w = SPACES.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                low, high = sorted((root(rows[a][0]), root(rows[b][0])))
                parent[high] = low
    return [(i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets)]


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("size, share", [(3, 90), (5, 80)])
def test_groups_equal_brute_force(spark, docs, nothing, texts, size, share):
    assert order(jaccard_join.grouped(docs, size=size, share=share).collect()) == order(brute_components(texts, size, share))
    assert jaccard_join.grouped(nothing).count() == 0
    kept = jaccard_join.keep_one(docs, size=size, share=share)
    named = {i: c for i, _, c in brute_components(texts, size, share)}
    assert sorted(r.n for r in kept.collect()) == [k for k, (i, _) in enumerate(texts) if i is None or named[i] == i]


def test_chains_of_near_copies_equal_brute_force(spark):
    rng = random.Random(9)
    rows, base = [], sentence(rng, 120).split()
    for i in range(150):
        own = list(base)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
        if i % 10 == 9:
            base = own
    table = spark.createDataFrame(rows, "doc_id int, text string")
    for size, share in ((3, 90), (5, 80)):
        assert order(jaccard_join.grouped(table, size=size, share=share).collect()) == order(brute_components(rows, size, share))


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b").union(spark.sql("select 900 as a, 901 as b"))
    got = dict(components.components(edges).collect())
    assert {got[i] for i in range(201)} == {0} and got[901] == 900


# 8 quality

def test_quality_is_learned_and_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(table, labels, usable=~quality.held_out())
    got = quality.scored(table, model).join(labels, "doc_id").where(quality.held_out()).collect()
    good, bad = [r.score for r in got if r.quality == 1], [r.score for r in got if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_descent_reaches_the_least_hinge_loss():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(12, rng.integers(1, 7), replace=False)) for _ in range(60)]
    scale, label = rng.standard_normal(12), np.where(rng.random(60) < 0.5, 1, -1)
    weight, bias = quality.descend(rows, scale, label, 1.0, 400, 0)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / np.sqrt((scale[r] ** 2).sum())
    x[:, 12] = 1  # the bias is one more weight

    def loss(w):
        return w @ w / 2 + np.maximum(0, 1 - label * (x @ w)).sum()

    plain, least = np.zeros(13), np.inf
    for step in range(1, 60_001):  # subgradient steps
        plain -= (plain - x.T @ (label * (label * (x @ plain) < 1))) / step
        least = min(least, loss(plain)) if step % 50 == 0 else least
    found = loss(np.append(weight, bias))
    assert found <= least * 1.0005 and least <= found * 1.02


def test_quality_of_odd_rows(docs, nothing, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (5, None, 0), (0, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    got = quality.scored(docs, quality.fit(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    same = {r.score for r in got if not SPACES.findall(r.text or "") and (r.text or "") == ""}
    assert len(same) == 1
    assert quality.scored(nothing, quality.fit(nothing, labels)).count() == 0
    many = docs.where("doc_id between 0 and 9").crossJoin(spark.range(30).select(F.col("id").alias("copy")))
    one = quality.fit(docs.where("doc_id between 0 and 9"), labels, max_rows=10)
    repeated = quality.fit(many, labels, max_rows=10)
    assert np.array_equal(one.coefficient, repeated.coefficient) and one.offset == repeated.offset
    few = quality.fit(docs, labels, max_features=1)
    assert not few.coefficient.any()
    only = quality.fit(docs, labels.where("quality = 1"))
    assert quality.scored(docs, only).agg(F.min("score")).first()[0] > 0.9


# 9 substrings

def brute_removed(rows, n):
    first = {}
    for i, t in rows:
        w = SPACES.findall(t or "")
        if i is not None:
            for k in range(len(w) - n + 1):
                key = tuple(w[k:k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = SPACES.findall(t or "")
        gone = set()
        if i is not None:
            for k in range(len(w) - n + 1):
                if first[tuple(w[k:k + n])] < i:
                    gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("n", [3, 13, 30])
def test_substrings_equal_brute_force(docs, nothing, texts, n):
    got = substring.remove_repeats(docs, n).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_removed(texts, n))
    assert substring.remove_repeats(nothing, n).count() == 0


def test_substrings_of_periodic_texts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id int, text string"), 6).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_removed(rows, 6))


# 10 WARC

def test_archives_come_back_exactly(spark):
    big = "ab\r\n\r\nWARC/1.1\r\n" * 200_000
    rows = [(1, "http://a/ü b\n", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
            (7, "u", "é" * 50), (8, "u", "é" * 50), (None, "u", "é" * 50), (7, "u", "é" * 50), (None, "u", "z" * 500)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, record_id string")
    got = order((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark, pages).collect())
    import hashlib
    expected = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, k in rows if j is not None and (k or "").encode() == data]
        back = len(data) >= 100 and bool(same) and i != min(same)
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if back else "response", min(same) if back else None))
    assert got == order(expected)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_chunks_rebuild_the_payload(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "0123456789" * 300_000)], "page_id bigint, url string, html string")
    manifest = warc.write_archives(warc.chunked(warc.classified(pages), 100_000), f"file://{tmp_path}/w")
    rows = sorted(warc.read_archives(spark, manifest).collect(), key=lambda r: r.chunk_no)
    assert len(rows) > 1 and b"".join(r.data for r in rows) == b"0123456789" * 300_000
    assert [r.bytes_so_far for r in rows] == list(np.cumsum([len(r.data) for r in rows])) and [r.is_last for r in rows][-1]


# pipeline

def test_pipeline_stages(spark):
    got = corpus_pipeline.run(spark, SMALL)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got.columns[:5] == documents.columns and 0 < got.count() <= documents.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near-copies", "benchmark", "mixing"]
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == documents.columns


def test_pipeline_on_odd_and_no_rows(spark, docs):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for given in (plain, plain.limit(0)):
        rows = given
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SMALL)
        assert rows.count() <= given.count()

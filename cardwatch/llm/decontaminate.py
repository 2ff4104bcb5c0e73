"""Benchmark decontamination by template canonicalisation.

Texts become sequences of lower-case words in which numbers, units and names (capitalised words inside a sentence) are
typed placeholders. Windows of ``window`` placeholders and words are hashed; windows of documents and of benchmark
items meet in a hash join, so that a question with other numbers or names still matches. A capitalised word that begins
a sentence may be a name or not: a window that starts with one has a second template in which it is a name. Hits of one
document and item on one alignment are then checked on their slots: over the whole alignment each value of the item must
stand for one value of the document, as when a question is re-parameterised (two values may become equal) and not when
unrelated texts happen to share a frame. Windows of the lower-case words themselves, where they differ from the
template, meet in the same join and count whatever the rest of the alignment holds, as what is a name depends on case and
on the word before. n_covered is the number of an item's words that lie in windows of equal words or of consistent
templates; a document contains the item if these are at least ``least_words``, or all.

Templates with fewer than ``window / 2`` plain words prove nothing and are not used; the second template needs one more.
An item shorter than a window is one window of its own length, from ``shortest`` words on, without a second template;
shorter items are never found.

The item side is written before the join, so that the planner knows its size: a small one is sent to the tasks, a large
one is joined by a shuffle of narrow rows. Only documents with a hit are looked at again.

Defined cases: null and empty texts match nothing; a null document id is reported as null; rows with equal ids are
told apart by their text and reported once per id and item; extra columns are not read; an empty benchmark gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.work import staged

MARK, FIRST = "\x01", "\x02"
NAME = r"([^.!?\x20\x09-\x0D] )(\p{Lu}\p{Ll}+)"
CAPITAL = r"(^|[^\p{L}\p{N}\x01])(\p{Lu}\p{Ll}+)"
TOKEN = f"[{MARK}{FIRST}]?" + r"[\p{L}\p{N}]+"
#: Words that stand for units of measure and of money.
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs pound pounds ounce ounces ton tons "
         "ml l liter liters litre litres second seconds minute minutes hour hours day days week weeks month months "
         "year years dollar dollars euro euros cent cents percent degrees celsius fahrenheit").split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def tokens(text: str) -> Column:
    """Lower-case words without punctuation; names and capitalised words that begin a sentence carry a mark each.

    Two passes find names that follow each other."""
    marked = F.col(text)
    for _ in range(2):
        marked = F.regexp_replace(marked, NAME, f"$1{MARK}$2")
    marked = F.regexp_replace(marked, CAPITAL, f"$1{FIRST}$2")
    return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN), F.lit(0))


def begins(token: Column) -> Column:
    return F.startswith(token, F.lit(FIRST))


def plain(words: Column) -> Column:
    """The words without the mark of a sentence's first."""
    return F.transform(words, lambda t: F.when(begins(t), F.substring(t, 2, 1 << 30)).otherwise(t))


def kind(token: Column) -> Column:
    """The token as it stands in a template. Marks sort before digits, digits before letters."""
    return (F.when(token < "0", F.lit("<name>")).when(token < ":", F.lit("<number>"))
            .when(token.isin(*UNITS), F.lit("<unit>")).otherwise(token))


def is_slot(token: Column) -> Column:
    return (token < ":") | token.isin(*UNITS)


def bare(token: Column) -> Column:
    """The token without its mark, as a name or not."""
    return F.replace(token, F.lit(MARK), F.lit(""))


def windows(frame: DataFrame, words: Column, sizes: list[int], window: int) -> DataFrame:
    """The frame with a row (_w: at, n, template, own, second) for every window of the given sizes: hashes of its template,
    of its words and, where it starts with the first word of a sentence, of the template in which that is a name.

    Words are hashed as an array; windows are rows of shifted arrays, so they are hashed in generated code.
    """
    def forms(marked: Column, words: Column) -> Column:
        hashed = lambda f: F.transform(words, lambda t: F.xxhash64(f(t)))
        return F.struct(hashed(kind).alias("k"), hashed(bare).alias("b"), F.transform(marked, begins).alias("first"))

    frame = frame.withColumn("_s", let(words, lambda marked: let(plain(marked), lambda words: forms(marked, words))))
    shifted = [F.slice(f"_s.{f}", i + 1, F.greatest(F.size(f"_s.{f}"), F.lit(1))).alias(f"{f}{i}") for f in "kb" for i in range(window)]
    rows = frame.select(*[c for c in frame.columns if c != "_s"],
                        F.posexplode(F.arrays_zip(*shifted, F.col("_s.first").alias("first"))).alias("_at", "_z"))

    def of(size: int) -> Column:
        k, b = ([F.col(f"_z.{f}{i}") for i in range(size)] for f in "kb")
        second = F.xxhash64(F.xxhash64(F.lit("<name>")), *k[1:]) if size == window else F.lit(None).cast("bigint")
        return F.when(k[-1].isNotNull(), F.struct(
            F.col("_at").alias("at"), F.lit(size).alias("n"), F.xxhash64(*k).alias("template"), F.xxhash64(*b).alias("own"),
            F.when(F.col("_z.first"), second).alias("second")))

    found = F.explode(F.array_compact(F.array(*map(of, sizes)))) if len(sizes) > 1 else of(sizes[0])
    return rows.select(*[c for c in frame.columns if c != "_s"], found.alias("_w")).where("_w is not null")


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", window: int = 8, least_words: int = 13, shortest: int = 5) -> DataFrame:
    """(key, item, n_covered, n_item_words) for every item that a document contains."""
    return (_matches(docs, items, key, text, item, item_text, window, least_words, shortest)
            .groupBy(F.col("_id").alias(key), F.col("_item").alias(item))
            .agg(F.max("n_covered").cast("bigint").alias("n_covered"),
                 F.max("_length").cast("bigint").alias("n_item_words")))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", window: int = 8, least_words: int = 13, shortest: int = 5) -> DataFrame:
    """The rows that contain no item."""
    found = _matches(docs, items, key, text, item, item_text, window, least_words, shortest)
    found = staged(found.select(F.col("_id").alias("__id"), F.col("_own").alias("__own")).distinct(), "contaminated")
    return docs.join(found, docs[key].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text]) == F.col("__own")), "left_anti")


def _matches(docs: DataFrame, items: DataFrame, key: str, text: str, item: str, item_text: str, window: int,
             least_words: int, shortest: int) -> DataFrame:
    """(_id, _own, _item, _length, n_covered); _own tells rows with equal ids apart by their text."""
    known = items.select(F.col(item).alias("_item"), tokens(item_text).alias("_item_words")).withColumn(
        "_length", F.size("_item_words")).where(F.col("_length") >= shortest)
    known = staged(known, "items")
    # at most window - shortest values
    short = [r[0] for r in known.where(F.col("_length") < window).select("_length").distinct().orderBy("_length").collect()]
    sizes = [*short, window]
    w = F.col("_w")
    frame = windows(known.withColumn("_plain", plain(F.col("_item_words"))), F.col("_item_words"), sizes, window)
    frame = frame.where((w["n"] == window) | (w["n"] == F.col("_length")))
    words = F.size(F.filter(F.slice("_plain", w["at"] + 1, w["n"]), lambda t: ~is_slot(t)))
    alike = w["template"] == w["own"]
    forms = F.array(F.struct(w["template"].alias("hash"), (words * 2 >= w["n"]).alias("template"), alike.alias("same")),
                    F.struct(w["own"].alias("hash"), F.lit(False).alias("template"), (~alike).alias("same")),
                    F.struct(w["second"].alias("hash"), ((words - 2) * 2 >= w["n"]).alias("template"), F.lit(False).alias("same")))
    frame = frame.select("_item", w["at"].alias("_item_at"), w["n"].alias("_n"), F.explode(forms).alias("_f")).where(
        "_f.hash is not null and (_f.template or _f.same)").select(
        "_item", "_item_at", "_n", F.col("_f.template").alias("_template"), F.col("_f.same").alias("_same"), F.col("_f.hash").alias("_hash"))
    frame = staged(frame, "item-windows")
    docs = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    own = F.xxhash64("_text")
    # a window without slots has one hash
    each = F.array_compact(F.array(w["template"], F.when(~alike, w["own"]), w["second"]))
    hits = (windows(docs.withColumn("_own", own), tokens("_text"), sizes, window)
            .select("_id", "_own", w["at"].alias("_at"), w["n"].alias("_n"), F.explode(each).alias("_hash"))
            .join(frame, ["_hash", "_n"]))
    hits = (hits.groupBy("_id", "_own", "_item", (F.col("_at") - F.col("_item_at")).alias("_shift"))
            .agg(F.collect_set(F.struct("_item_at", "_n", "_template", "_same")).alias("_hits")))
    hits = staged(hits, "hits")
    touched = staged(hits.select(F.col("_id").alias("_k"), F.col("_own").alias("_o")).distinct(), "touched")
    # merged at every size: hits grow with the corpus
    again = (docs.withColumn("_own", own).join(touched.hint("merge"), F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_own") == F.col("_o")))
             .select("_k", "_o", plain(tokens("_text")).alias("_words")).dropDuplicates(["_k", "_o"]))
    again = staged(again, "touched-words")
    both = (hits.join(again.hint("merge"), F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_own") == F.col("_o")))
            .join(known.withColumn("_plain", plain(F.col("_item_words"))), "_item"))

    def places(found: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(
            found, lambda h: F.sequence(h["_item_at"], h["_item_at"] + h["_n"] - 1))))

    both = both.withColumn("_covered", places(F.filter("_hits", lambda h: h["_template"])))
    both = both.withColumn("_exact", places(F.filter("_hits", lambda h: h["_same"])))
    pairs = F.array_distinct(F.transform(F.filter(
        F.transform("_covered", lambda i: F.struct(
            F.get("_plain", i).alias("item"), bare(F.get("_words", i + F.col("_shift"))).alias("doc"),
            (is_slot(F.get("_plain", i)) | begins(F.get("_item_words", i))).alias("slot"))),
        lambda p: p["slot"]), lambda p: F.struct(bare(p["item"]).alias("item"), p["doc"].alias("doc"))))
    both = both.withColumn("_pairs", pairs)
    consistent = F.size(F.array_distinct(F.col("_pairs.item"))) == F.size("_pairs")
    both = both.withColumn("_covered", F.when(consistent, F.col("_covered")).otherwise(F.array().cast("array<int>")))

    covered = F.size(F.array_distinct(F.flatten(F.concat(F.collect_list("_covered"), F.collect_list("_exact")))))
    return (both.groupBy("_id", "_own", "_item", "_length").agg(covered.alias("n_covered"))
            .where(F.col("n_covered") >= F.least(F.lit(least_words), F.col("_length"))))

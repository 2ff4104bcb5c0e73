"""Line dedup by a fixed-depth template tree: number of tokens, leading tokens, then templates at the leaf.

Tokens with a digit are variable fields from the start, unless more than half of a line's tokens are. A line descends by
its number of tokens and its first ``depth`` tokens to a leaf. The leaf's most frequent line is its main template; lines
that agree with it on at least ``similarity`` of the tokens behind the leading ones belong to it, whatever stands in their
differing fields. A template found in at least ``least_docs`` documents recurs: its first line, by document and position,
stays, and all its other lines are dropped.

A leaf may hold several templates. Lines that belong to no recurring one descend further, first by the next ``depth``
tokens and then, those still left, from the leaf by the last ``depth`` tokens; each of these leaves has a main template
of its own. So a line's fate does not depend on unlike lines of its first leaf, and the levels are a fixed number. Lines that
fit no main template count as templates of their own, word for word. Lines of fewer than ``least_tokens`` tokens are never
dropped.

First leaves are counted on narrow rows; only lines of those that reach ``least_docs`` documents are compared, and
only positions are joined back to the documents. Counts are combined before each shuffle, and joins are between
written tables, so adaptive execution can split the rows of a line that a third of all documents have.

Defined cases: null text stays null, empty text stays empty; rows without an id count as one document behind all
others when looking for the first line, and as none when documents are counted; rows with equal ids are one document;
a document of which every line goes keeps its row with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.work import discard, staged

#: A token with a digit; possessive, so that long tokens cost linear time.
FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
SPACE = r"[\x20\x09-\x0D]+"


def plain(line: Column) -> Column:
    """Tokens of the line joined by one blank; most lines are so already."""
    return F.trim(F.when(line.rlike(r"[\x09-\x0D]|  "), F.regexp_replace(line, SPACE, " ")).otherwise(line))


def n_tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1


def once(value: Column) -> Column:
    """The value behind a generator, so that the optimizer does not repeat it wherever it is used."""
    return F.explode(F.array(value))


def lines(docs: DataFrame, key: str, text: str, depth: int, least_tokens: int) -> DataFrame:
    """(_id, _pos, _leaf, _line) of every line with enough tokens.

    A line is its tokens joined by one blank, with <*> for tokens with a digit unless these are most of it and would
    leave no template.
    """
    rows = docs.select(F.col(key).alias("_id"), F.posexplode(F.split(F.col(text), "\n")).alias("_pos", "_raw"))
    fields = F.when(F.col("_raw").rlike("[0-9]"), plain(F.regexp_replace("_raw", FIELD, "<*>")))
    rows = rows.select("_id", "_pos", once(F.struct(plain(F.col("_raw")).alias("plain"), fields.alias("masked"))).alias("_l"))
    found = F.col("_l.masked")
    many = (F.length(found) - F.length(F.replace(found, F.lit("<*>")))) * 2 > n_tokens(found) * 3
    rows = rows.select("_id", "_pos", once(F.when(found.isNull() | many, F.col("_l.plain")).otherwise(found)).alias("_line"))
    tokens = n_tokens(F.col("_line"))
    return (rows.where((F.col("_line") != "") & (tokens >= least_tokens))
            .select("_id", "_pos", F.xxhash64(tokens, F.substring_index("_line", " ", depth)).alias("_leaf"), "_line"))


def agreement(line: str, other: str, depth: int) -> Column:
    """Share of equal tokens behind the leading ones; 1 where there are none."""
    left, right = F.split(F.col(line), " "), F.split(F.col(other), " ")
    same = F.zip_with(left, right, lambda a, b: (a == b).cast("int"))
    count = F.aggregate(same, F.lit(0), lambda total, x: total + x)
    rest = F.size(left) - depth
    return F.when(rest <= 0, F.lit(1.0)).otherwise((count - depth) / F.greatest(rest, F.lit(1)))


def branches(depth: int) -> list[Column]:
    """The leaf of a line at each level of the tree."""
    line = F.col("_line")
    return [F.col("_leaf"), F.xxhash64("_leaf", F.substring_index(line, " ", 2 * depth)),
            F.xxhash64("_leaf", F.substring_index(line, " ", -depth))]


def first_places(rows: DataFrame, by: list[str], place: Column, least_docs: int) -> DataFrame:
    """Templates found in enough documents, with the place of their first line."""
    return (rows.groupBy(*by).agg(F.countDistinct("_id").alias("_n"), F.min(place).alias("_first"))
            .where(F.col("_n") >= least_docs).drop("_n"))


def generalised(rows: DataFrame, place: Column, depth: int, least_docs: int, similarity: float,
                level: int) -> tuple[DataFrame, DataFrame]:
    """One level: lines outside its recurring main templates, and (_id, _pos) of the lines that these drop."""
    counts = rows.groupBy("_at", "_line").agg(F.countDistinct("_id").alias("_n"))
    main = counts.groupBy("_at").agg(F.min_by("_line", F.struct(-F.col("_n"), F.col("_line"))).alias("_main"),
                                     F.sum("_n").alias("_docs"))
    # the sum counts a document once a line, so it is no less than the number of documents
    main = staged(main.where(F.col("_docs") >= least_docs).select("_at", "_main"), f"main-templates-{level}")
    inside = F.coalesce(agreement("_line", "_main", depth) >= similarity, F.lit(False))
    tried = staged(rows.join(main, "_at", "left").select("_id", "_pos", "_leaf", "_at", "_line", inside.alias("_in")),
                   f"templates-{level}")
    recurring = staged(first_places(tried.where("_in"), ["_at"], place, least_docs), f"recurring-{level}")
    named = tried.join(recurring, "_at", "left")
    member = F.col("_in") & F.col("_first").isNotNull()
    lost = staged(named.where(member & (place != F.col("_first"))).select("_id", "_pos"), f"dropped-{level}")
    rest = staged(named.where(~member).select("_id", "_pos", "_leaf", "_line"), f"unlike-lines-{level}")
    discard(rows, main, tried, recurring)
    return rest, lost


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = 3, least_docs: int = 5,
                   similarity: float = 0.7, least_tokens: int = 2) -> DataFrame:
    """All rows and columns with the text of the remaining lines, and n_lines and n_dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    found = lines(docs, key, text, depth, least_tokens)
    leaves = staged(found.groupBy("_leaf").agg(F.countDistinct("_id").alias("_n")).where(F.col("_n") >= least_docs)
                    .select("_leaf"), "leaves")
    found = staged(found.join(leaves, "_leaf"), "leaf-lines")
    place = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_pos"))
    rest, dropped = found, []
    for level, branch in enumerate(branches(depth)):
        rest, lost = generalised(rest.withColumn("_at", branch), place, depth, least_docs, similarity, level)
        dropped.append(lost)
    discard(leaves)
    alone = rest.withColumn("_own", F.xxhash64("_line"))
    recurring = staged(first_places(alone, ["_leaf", "_own"], place, least_docs), "recurring")
    gone = alone.join(recurring, ["_leaf", "_own"]).where(place != F.col("_first")).select("_id", "_pos")
    for lost in dropped:
        gone = gone.union(lost)
    gone = gone.groupBy("_id").agg(F.collect_set("_pos").alias("__gone"))
    gone = staged(gone, "dropped-lines").withColumnRenamed("_id", "__gone_id")
    discard(rest, recurring, *dropped)
    parts = F.split(F.col(text), "\n")
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone")))
    left = F.array_join(F.transform(kept, lambda i: F.element_at(parts, i + 1)), "\n")
    there = F.col("__gone").isNotNull() & F.col(text).isNotNull()
    # merged at every size: what is dropped grows with the corpus
    return (docs.join(gone.hint("merge"), F.col(key).eqNullSafe(F.col("__gone_id")), "left")
            .withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("bigint"))
            .withColumn("n_dropped", F.when(there, F.col("n_lines") - F.size(kept)).otherwise(0).cast("bigint"))
            .withColumn(text, F.when(there, left).otherwise(F.col(text))).drop("__gone", "__gone_id"))

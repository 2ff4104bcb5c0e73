"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

A source's target is its weight's share of the budget, at most ``max_epochs`` times its own size. What the capped
sources cannot use is shared again by weight among the others, until no target is above its cap. A source whose
target is 2.4 times its size takes each document twice and a seeded choice of documents, worth the remaining 0.4 of
its size, once more.

The choice is a threshold on a seeded hash of the document key: documents below it, in hash order, add up to the
fraction as nearly as whole documents can (the last one counts if its middle is still inside). The threshold is found
by a histogram of hash prefixes per source, then by the rows of the one prefix where the sum is reached; so no source
is ever sorted or gathered as a whole, and documents themselves are not shuffled. Where the threshold falls among rows
of one key (or among many without one), it is refined the same way by a hash of the whole row.

Defined cases: null text has size 0; a null source is a source of its own; a null key hashes as a fixed text; rows equal
in all columns share both hashes and are taken together (columns that hold maps are not looked at); an empty table gives an empty result; sources of size 0 have target 0; columns named like a result are replaced.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.work import numbered, staged

HASH_BITS = 60
PREFIX_BITS = 12


def n_words(text: str = "text") -> Column:
    """Number of words of the whole text; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def seeded(key: str, seed: int) -> Column:
    """60 bits of a hash of the key, the same on every run and engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def rising_weights(sources: DataFrame, source: str, cycle: int = 3) -> DataFrame:
    """Weights 1 to ``cycle``, repeating, over the sources by code point, null last."""
    return (numbered(sources, F.col(source).asc_nulls_last(), "_rank", "mix-rank")
            .withColumn("weight", (F.col("_rank") % cycle + 1).cast("bigint")).drop("_rank"))


def water_level(weighted: DataFrame, max_epochs: int) -> tuple[int, int]:
    """(budget left, weights left) once every source that would pass its cap is clamped.

    One row is fetched per round; each round clamps at least one more source or ends.
    """
    cap = F.col("source_size") * max_epochs
    total, weights = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    total, left, share = int(total or 0), int(total or 0), int(weights or 0)
    while share:
        over = (F.col("weight").cast("decimal(20,0)") * F.lit(Decimal(left))
                > cap.cast("decimal(20,0)") * F.lit(Decimal(share)))
        used, rest = weighted.agg(F.sum(F.when(over, cap).otherwise(0)),
                                  F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if (total - int(used), int(rest)) == (left, share):
            break
        left, share = total - int(used), int(rest)
    return left, share


def targets(sizes: DataFrame, max_epochs: int = 3) -> DataFrame:
    """Adds target, whole repetitions and the rest in exact units of 1/share to (source_size, weight)."""
    left, share = water_level(sizes, max_epochs)
    size, wide = F.col("source_size"), "decimal(20,0)"
    asked = F.col("weight").cast(wide) * F.lit(Decimal(left))
    full = size.cast(wide) * F.lit(Decimal(max(share, 1)))
    capped = (asked > full * max_epochs) | F.lit(share == 0)
    return (sizes.withColumn("_asked", asked).withColumn("_full", full)
            .withColumn("target", F.when(capped, (size * max_epochs).cast("double"))
                        .otherwise(asked.cast("double") / F.lit(float(max(share, 1)))))
            .withColumn("whole", F.when(size == 0, F.lit(0)).when(capped, F.lit(max_epochs))
                        .otherwise(F.expr("cast(_asked div greatest(_full, cast(1 as decimal(38,0))) as int)")))
            .withColumn("_rest", F.when(capped | (size == 0), F.lit(Decimal(0)))
                        .otherwise(F.col("_asked") - F.col("whole") * F.col("_full")).cast("decimal(38,0)"))
            .withColumn("_share", F.lit(Decimal(max(share, 1))).cast(wide)).drop("_asked", "_full"))


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def prefix() -> Column:
    return F.shiftright("_u", HASH_BITS - PREFIX_BITS)


def histogram(rows: DataFrame, label: str) -> DataFrame:
    """Words per source and hash prefix: at most 2^12 rows per source."""
    return staged(rows.groupBy("_source", prefix().alias("_prefix")).agg(F.sum("size").alias("_words")), label)


def row_hash(df: DataFrame) -> Column:
    """60 bits of a hash of all columns that have one."""
    columns = [F.col(f"`{f.name}`") for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - HASH_BITS)


def threshold(rows: DataFrame, blocks: DataFrame, plan: DataFrame, label: str, split: bool) -> DataFrame:
    """Per source (_s) with a rest: the largest hash that is taken (_last).

    ``plan`` has the words counted already (_start). With ``split``, rows of one hash that would pass the rest are not
    taken, and given as _edge with the words before them (_begin).
    """
    # the prefix in which the running sum passes the rest
    running = ("sum(_words) over (partition by _source order by _prefix "
               "rows between unbounded preceding and 1 preceding)")
    found = (blocks.withColumn("_earlier", F.expr(f"coalesce({running}, 0L)"))
             .join(plan.select(F.col("_source").alias("_s"), "_rest", "_share", "_start"), same("_source", "_s"))
             .withColumn("_before", F.col("_start") + F.col("_earlier"))
             .where((F.col("_rest") > 0) & ((F.col("_before") * F.col("_share")) < F.col("_rest"))
                    & ((F.col("_before") + F.col("_words")) * F.col("_share") >= F.col("_rest")))
             .select("_s", F.col("_prefix").alias("_p"), "_before", "_rest", "_share"))
    found = staged(found, f"{label}-edges")
    near = (rows.join(found, same("_source", "_s") & (prefix() == F.col("_p")))
            .groupBy("_s", "_u", "_p", "_before", "_rest", "_share")
            .agg(F.sum("size").alias("_words"), F.count("*").alias("_n")))
    inside = "coalesce(sum(_words) over (partition by _s order by _u rows between unbounded preceding and 1 preceding), 0L)"
    parted = (F.col("_n") > 1) & F.lit(split)
    # half units keep the middle of a document exact
    reached = 2 * F.col("_begin") + F.when(parted, 2 * F.col("_words")).otherwise(F.col("_words"))
    fits = reached * F.col("_share") <= 2 * F.col("_rest")
    edge = parted & ~fits & (F.col("_begin") * F.col("_share") < F.col("_rest"))
    last = (near.withColumn("_begin", F.col("_before") + F.expr(inside))
            .groupBy("_s").agg(F.max(F.when(fits, F.col("_u"))).alias("_last"),
                               F.min(F.shiftleft("_p", HASH_BITS - PREFIX_BITS) - 1).alias("_none"),
                               F.min(F.when(edge, F.struct("_u", "_begin"))).alias("_at")))
    return staged(last.select("_s", F.coalesce("_last", "_none").alias("_last"), F.col("_at._u").alias("_edge"),
                              F.col("_at._begin").alias("_begin")), f"{label}-last")


def mix(docs: DataFrame, size: Column, key: str = "doc_id", source: str = "source", max_epochs: int = 3,
        seed: int = 0, weights: DataFrame | None = None) -> DataFrame:
    """All rows with size, source_size, target, repeats and taken (size times repeats).

    ``weights``: (source, weight) with whole weights; by default 1, 2, 3 repeating in order of the sources.
    """
    docs = docs.drop("size", "source_size", "target", "repeats", "taken")
    rows = staged(docs.select(F.col(source).alias("_source"), seeded(key, seed).alias("_u"), size.alias("size")),
                  "mix-rows")
    blocks = histogram(rows, "mix-blocks")
    sizes = blocks.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    weighted = (rising_weights(sizes, "_source") if weights is None else
                sizes.join(weights.select(F.col(source).alias("_k"), F.col("weight").cast("bigint").alias("weight")),
                           F.col("_source").eqNullSafe(F.col("_k")), "left").drop("_k")
                .withColumn("weight", F.coalesce("weight", F.lit(0).cast("bigint"))))
    plan = staged(targets(staged(weighted, "mix-sizes"), max_epochs), "mix-plan")

    last = threshold(rows, blocks, plan.withColumn("_start", F.lit(0).cast("bigint")), "mix", split=True)
    ties = last.where(F.col("_edge").isNotNull()).select("_s", "_edge", F.col("_begin").alias("_start"))
    tied = not ties.isEmpty()
    if tied:
        whole = docs.select(F.col(source).alias("_source"), seeded(key, seed).alias("_k"), row_hash(docs).alias("_u"),
                            size.alias("size"))
        among = staged(whole.join(ties, same("_source", "_s") & (F.col("_k") == F.col("_edge")))
                       .select("_source", "_u", "size"), "mix-ties")
        inner = threshold(among, histogram(among, "mix-tie-blocks"), plan.join(ties, same("_source", "_s")).drop("_s"),
                          "mix-tie", split=False)
        last = last.join(inner.select(F.col("_s").alias("_t"), F.col("_last").alias("_edge_last")), same("_s", "_t"), "left")
    plan = staged(plan.join(last, same("_source", "_s"), "left").select(
        F.col("_source").alias("__source"), "source_size", "target", F.col("whole").alias("__whole"),
        F.coalesce("_last", F.lit(-1)).alias("__last"), F.col("_edge").alias("__edge"),
        (F.col("_edge_last") if tied else F.lit(None).cast("bigint")).alias("__edge_last")), "mix-sources")
    once_more = F.col("__hash") <= F.col("__last")
    if tied:
        once_more = once_more | F.coalesce((F.col("__hash") == F.col("__edge")) & (row_hash(docs) <= F.col("__edge_last")),
                                           F.lit(False))
    return (docs.withColumn("__size", size).withColumn("__hash", seeded(key, seed)).join(plan, same(source, "__source"))
            .withColumn("repeats", F.col("__whole") + once_more.cast("int"))
            .withColumnRenamed("__size", "size").withColumn("taken", F.col("size") * F.col("repeats"))
            .drop("__source", "__hash", "__whole", "__last", "__edge", "__edge_last")
            .select(*docs.columns, "size", "source_size", "target", "repeats", "taken"))

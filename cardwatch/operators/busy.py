"""Keys that own more rows than one task should hold, and exact positions of their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.session import staged

#: A list of busy keys up to this length is broadcast; a longer one is joined by merging.
FEW_KEYS = 100_000
ROWS = "_rows"


def busy_keys(df: DataFrame, keys: Sequence[str], most: int, sizes: DataFrame | None = None) -> DataFrame | None:
    """(keys, _rows) of keys with more than ``most`` rows, a missing key among them; None if there are none.

    ``sizes`` are counts (keys, _rows) that are known already.
    """
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count("*").alias(ROWS))
    busy = sizes.where(F.col(ROWS) > most).select(*keys, ROWS)
    few = busy.limit(FEW_KEYS + 1).collect()
    if not few:
        return None
    if len(few) <= FEW_KEYS:
        return F.broadcast(df.sparkSession.createDataFrame(few, busy.schema))
    return staged(df.sparkSession, busy, "busy-keys").hint("merge")


def beside(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``df`` with the other columns of ``other``, which has one row per key; missing keys are equal."""
    renamed = other.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                           *[c for c in other.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return df.join(renamed, same, how).drop(*[f"_key{i}" for i in range(len(keys))])


def positions(df: DataFrame, key: str, order: Sequence[str | Column], name: str) -> DataFrame:
    """Adds each row's number from 0 within its key, whatever a key's share of the rows, and reads the result back.

    Rows are sorted by range, so a busy key or a busy instant is spread over tasks, and numbered inside each partition.
    One number per partition, and the first number of each key, make positions of them.
    """
    spark = df.sparkSession
    placed = staged(spark, df.orderBy(key, *order).withColumn("_at", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = sizes.select("_part", F.expr("coalesce(sum(_n) over (order by _part rows between unbounded preceding "
                                           "and 1 preceding), 0L)").alias("_earlier"))
    numbered = (placed.withColumn("_part", part).join(F.broadcast(earlier), "_part")
                .withColumn("_at", F.col("_earlier") + F.col("_at") - F.shiftleft("_part", 33)).drop("_part", "_earlier"))
    first = staged(spark, numbered.groupBy(key).agg(F.min("_at").alias("_first")), "first-positions")
    return beside(numbered, first, [key]).withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_first")

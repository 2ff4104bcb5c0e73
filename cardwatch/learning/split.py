"""Repeatable stratified split with an exact share of every class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.busy import FEW_KEYS, beside
from cardwatch.session import staged

#: Digits of the hash that one round looks at, and rounds: 60 bits in all.
BITS, ROUNDS = 12, 5


def seeded_rank(key: str, seed: int):
    """60 bits of a hash of the key, the same on every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, BITS * ROUNDS // 4), 16, 10).cast("bigint")


def stratified(df: DataFrame, test_share: float = 0.2, key: str = "transaction_id", label: str = "is_fraud",
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(training, test): of each class, a missing label among them, the rows of lowest seeded hash are the test part.

    A class of n rows gives test_share * n of them, rounded half up. Instead of sorting, the threshold of each class is
    found digit by digit: a histogram of the leading digit shows the digit within which the share is reached, and only
    rows of that digit are looked at in the next round. Rows of equal hash are taken in order of the key.
    """
    spark, low, high = df.sparkSession, "_hash", BITS * ROUNDS
    narrow = df.select(F.col(label).alias("_class"), seeded_rank(key, seed).alias(low))
    wanted = F.floor(F.count("*") * F.lit(test_share) + 0.5).cast("bigint")
    bounds = narrow.groupBy("_class").agg(wanted.alias("_need")).withColumn("_prefix", F.lit(0).cast("bigint"))
    rows = narrow
    for turn in range(ROUNDS):
        bounds = _few(spark, bounds)
        shift = high - BITS * (turn + 1)
        here = beside(rows, bounds, ["_class"]).where(F.shiftright(low, shift + BITS) == F.col("_prefix"))
        if turn:  # one digit's rows are few
            here = staged(spark, here, "threshold-rows")
        rows = here.select("_class", low)
        counts = here.groupBy("_class", "_need", F.shiftright(low, shift).alias("_prefix")).agg(F.count("*").alias("_n"))
        upto = "sum(_n) over (partition by _class order by _prefix rows between unbounded preceding and current row)"
        reached = counts.withColumn("_upto", F.expr(upto)).where(F.col("_upto") >= F.col("_need"))
        bounds = reached.groupBy("_class").agg(F.min(F.struct("_prefix", "_upto", "_n", "_need")).alias("b")).select(
            "_class", F.col("b._prefix").alias("_prefix"), (F.col("b._need") - F.col("b._upto") + F.col("b._n")).alias("_need"))
    bounds = _few(spark, bounds.withColumnRenamed("_class", label))
    marked = beside(df.withColumn(low, seeded_rank(key, seed)), bounds, [label])
    order = F.expr(f"row_number() over (partition by `{label}` order by `{key}`)")
    even = marked.where(F.col(low) == F.col("_prefix")).withColumn("_place", order)
    test = marked.where(F.col(low) < F.col("_prefix")).select(*df.columns).unionByName(
        even.where(F.col("_place") <= F.col("_need")).select(*df.columns))
    train = marked.where(F.col(low) > F.col("_prefix")).select(*df.columns).unionByName(
        even.where(F.col("_place") > F.col("_need")).select(*df.columns))
    return train, test


def _few(spark, bounds: DataFrame) -> DataFrame:
    """One row per class, checked to be few enough to send to every task."""
    found = bounds.limit(FEW_KEYS + 1).collect()
    if len(found) > FEW_KEYS:
        raise ValueError(f"more than {FEW_KEYS} classes")
    return F.broadcast(spark.createDataFrame(found, bounds.schema))

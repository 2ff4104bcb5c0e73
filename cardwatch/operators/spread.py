"""Join of rows with one row per key, for keys that may own a large share of the rows.

Adaptive execution splits a skewed join only if both sides come straight from a shuffle, which is not so when one side is
an aggregate on the join key. So the rows of busy keys, a missing key among them, are spread over numbered copies of
their counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.numbers import whole_div
from cardwatch.operators.busy import ROWS, beside, busy_keys

COPY = "_copy"


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str | Sequence[str] = "customer_id", how: str = "left",
                 row_id: str = "transaction_id", rows_per_copy: int = 2_000_000,
                 sizes: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``per_key`` (unique in ``key``); same result as a plain join.

    ``sizes`` are rows per key (key, _rows) where they are known; else they are counted.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if rows.isStreaming:  # a stream has no counts; its batches are bounded by the trigger
        return rows.join(per_key, keys, how)
    busy = busy_keys(rows, keys, rows_per_copy, sizes)
    if busy is None:
        return rows.join(per_key, keys, how)
    copies = whole_div(F.col(ROWS), F.lit(rows_per_copy)) + 1
    left = beside(rows, busy, keys).withColumn(
        COPY, F.coalesce(F.pmod(F.xxhash64(row_id), copies), F.lit(0))).drop(ROWS)
    last = F.coalesce(copies - 1, F.lit(0).cast("bigint"))
    right = beside(per_key, busy, keys).withColumn(COPY, F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop(ROWS)
    return left.join(right, [*keys, COPY], how).drop(COPY)

"""Registry of named queries and the SQL that must give the same rows.

Each entry runs one operator over the whole given tables. ``flat`` turns arrays
into text, times into milliseconds and dates into text, so that results compare
by value in any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions import rules
from cardwatch.operators import shape
from cardwatch.plans.sql import PRELUDE
from cardwatch.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(build(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = PRELUDE + sql
        return build

    return register


def flat(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ";")
        elif isinstance(kind, T.TimestampType):
            column = F.unix_millis(column)
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.transactions(spark, sf_dir)


def tx_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.transactions(spark, sf_dir, balance=True)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions under the stream rules, with the event hour."""
    return rules.apply(shape.enrich(tx(spark, sf_dir)), rules.stream_rules())


# Fixed value: first millisecond after the days that form the profile history (21 January 2024, UTC).
HISTORY_END_MS = 1_705_795_200_000


def history_of(df: DataFrame) -> DataFrame:
    """The earlier transactions, from which profiles are built before the rest is scored."""
    return df.where(F.col("timestamp_ms") < HISTORY_END_MS)

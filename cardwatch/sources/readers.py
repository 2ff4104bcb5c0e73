"""Readers of transaction files; all return canonical columns with ``amount_cents``."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.functions.numbers import CENTS, cents
from cardwatch.operators.shape import normalize
from cardwatch.schemas import TRANSACTION, TRANSACTION_INPUT

BAD_LINE = "_bad_line"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines without header, fields by position, the label optional.

    Blank device and address become null. A line is kept if its required typed
    fields can be read; a header line cannot and goes away with other bad lines.
    """
    return _positional(spark, path).where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def read_text_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines ``read_text`` leaves out, as they are."""
    return _positional(spark, path).where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def _positional(spark: SparkSession, path: str) -> DataFrame:
    """Fields by position, read as text first: the CSV reader pads lines without label with null."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in TRANSACTION]
                           + [T.StructField("_raw", T.StringType())])
    raw = (spark.read.schema(as_text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw")
           .option("ignoreTrailingWhiteSpace", True).csv(path))
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in TRANSACTION}
    parsed = raw.select(*[typed[f.name].alias(f.name) for f in TRANSACTION],
                        F.array(*[F.col(f.name) for f in TRANSACTION]).alias("_fields"), "_raw")
    needed = [f.name for f in TRANSACTION if not f.nullable]
    broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    line = F.when(broken, F.coalesce("_raw", F.array_join("_fields", ",", "")))
    return parsed.withColumns({CENTS: cents("amount"), BAD_LINE: line}).drop("_fields", "_raw")


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_INPUT) -> DataFrame:
    """CSV with header and fixed schema."""
    return normalize(spark.read.option("header", True).schema(schema).csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_INPUT) -> DataFrame:
    """JSON lines with fixed schema."""
    return normalize(spark.read.schema(schema).json(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalize(spark.read.parquet(path))


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType = TRANSACTION) -> DataFrame:
    """A frame of local rows (for tests and small lists)."""
    return normalize(spark.createDataFrame(list(rows), schema))

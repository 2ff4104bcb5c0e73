"""Table statistics merged from a sketch per file, so that a new day is the only thing that is scanned.

The store has one row per data file: rows, and per column nulls, least, greatest value and a sketch of its distinct
values. A file is known by path, time and length (as in ``intake``): a renewal scans files the store does not have, and
the merged statistics are those of the files that are in the table now, so rewritten, dropped and archived files leave
them without a scan. Counts and extremes are exact; distinct counts have a relative standard error of
1.04 / sqrt(2^lg_k), 1.6 % by default. A lost renewal is simply repeated; a file sketched twice counts once.

Defined cases: a table without files has no rows; columns without values have 0 distinct ones; arrays, maps and
structures are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.operators import intake

LG_K = 12


def plain_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]


def store_schema(schema: T.StructType) -> T.StructType:
    fields = [*intake.FILE, T.StructField("rows", T.LongType())]
    for name in plain_columns(schema):
        kind = schema[name].dataType
        fields += [T.StructField(f"nulls_{name}", T.LongType()), T.StructField(f"least_{name}", kind),
                   T.StructField(f"most_{name}", kind), T.StructField(f"sketch_{name}", T.BinaryType())]
    return T.StructType(fields)


def stored(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    spark.createDataFrame([], store_schema(schema)).write.mode("ignore").parquet(store)
    return spark.read.schema(store_schema(schema)).parquet(store)


def unseen_rows(spark: SparkSession, folder: str, store: str, schema: T.StructType) -> DataFrame:
    """The table's rows in files that the store does not have, with their file's path, time and length."""
    named = {"_path": "file_path", "_time": "file_modification_time", "_bytes": "file_size"}
    marks = {name: F.col(f"_metadata.{field}") for name, field in named.items()}
    fresh = intake.files(spark, folder).join(stored(spark, store, schema), intake.FILE.names, "left_anti").select("path")
    few = [r[0] for r in fresh.limit(intake.FEW_FILES + 1).collect()]
    if not few:
        return spark.createDataFrame([], T.StructType([*schema, *[T.StructField(n, f.dataType) for n, f in zip(named, intake.FILE)]]))
    if len(few) <= intake.FEW_FILES:
        return spark.read.schema(schema).option("basePath", folder).parquet(*few).withColumns(marks)
    rows = spark.read.schema(schema).parquet(folder).withColumns(marks)
    return rows.join(fresh.select(F.col("path").alias("_path")).hint("merge"), "_path", "left_semi")


def renew(spark: SparkSession, folder: str, store: str, schema: T.StructType, lg_k: int = LG_K) -> None:
    """Adds a row per new file of a Parquet table to the store; ``schema`` includes the partition columns."""
    rows = unseen_rows(spark, folder, store, schema)
    measures = [F.count("*").alias("rows")]
    for name in plain_columns(schema):
        value = F.col(f"`{name}`")
        measures += [F.count_if(value.isNull()).alias(f"nulls_{name}"), F.min(value).alias(f"least_{name}"),
                     F.max(value).alias(f"most_{name}"),
                     F.hll_sketch_agg(value.cast("string"), lg_k).alias(f"sketch_{name}")]
    file = [F.col(c).alias(n) for c, n in zip(("_path", "_time", "_bytes"), intake.FILE.names)]
    rows.groupBy(*file).agg(*measures).write.mode("append").parquet(store)


def merged(spark: SparkSession, folder: str, store: str, schema: T.StructType) -> DataFrame:
    """(column_name, row_count, null_count, least, most, distinct_count) of the files in the table now."""
    now = intake.files(spark, folder)
    known = stored(spark, store, schema).dropDuplicates(intake.FILE.names).join(now, intake.FILE.names, "left_semi")
    names = plain_columns(schema)
    measures = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for i, name in enumerate(names):
        measures += [F.coalesce(F.sum(f"`nulls_{name}`"), F.lit(0)).alias(f"n{i}"), F.min(f"`least_{name}`").alias(f"a{i}"),
                     F.max(f"`most_{name}`").alias(f"z{i}"),
                     F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"`sketch_{name}`")), F.lit(0)).alias(f"d{i}")]
    told = [F.struct(F.lit(name).alias("column_name"), F.col("rows").alias("row_count"), F.col(f"n{i}").alias("null_count"),
                     F.col(f"a{i}").cast("string").alias("least"), F.col(f"z{i}").cast("string").alias("most"),
                     F.col(f"d{i}").cast("bigint").alias("distinct_count")) for i, name in enumerate(names)]
    return known.agg(*measures).select(F.explode(F.array(*told)).alias("_c")).select("_c.*")

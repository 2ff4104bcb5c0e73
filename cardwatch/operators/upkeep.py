"""Partition upkeep: archiving, compaction, statistics, incremental input.

Both rewrites leave the old files alone and only change what the catalog points
to, so a lost executor or a failed run never leaves a table half written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.sources import writers


ARCHIVED = "cardwatch.archived-before"


def partition_filter(spec: dict[str, str]) -> str:
    return " AND ".join(f"`{k}` = '{v}'" for k, v in spec.items())


def _partition_sql(spec: dict[str, str]) -> str:
    return ", ".join(f"`{k}` = '{v}'" for k, v in spec.items())


class DamagedCopy(ValueError):
    """The archive does not hold what the table holds."""


def archive_before(spark: SparkSession, table: str, archive_path: str, date_column: str, before: str) -> None:
    """Copies all days before a date to the archive, compares, then drops them from the table's catalog entry.

    The write replaces whole day partitions, so it may be repeated.
    """
    copy_before(spark, table, archive_path, date_column, before)
    drop_archived(spark, table, archive_path, date_column, before)


def copy_before(spark: SparkSession, table: str, archive_path: str, date_column: str, before: str) -> None:
    old = spark.table(table).where(F.col(date_column) < F.lit(before).cast("date"))
    (writers.balanced(old, [date_column]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_column).parquet(archive_path))


def drop_archived(spark: SparkSession, table: str, archive_path: str, date_column: str, before: str) -> None:
    """Drops the days before a date from the catalog if the archive holds the same rows of each, else raises."""
    old = spark.table(table).where(F.col(date_column) < F.lit(before).cast("date"))
    copy = spark.read.schema(old.schema).parquet(archive_path)
    damaged = differing_days(old, copy.where(F.col(date_column) < F.lit(before).cast("date")), date_column)
    if damaged:
        raise DamagedCopy(f"days that differ in {archive_path}: {', '.join(damaged[:10])}")
    # remembered, as a later repair finds the files of these days again
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{ARCHIVED}' = '{date_column}={before}')")
    _forget_archived(spark, table)


def checksums(df: DataFrame, by: str) -> DataFrame:
    """Per day, the number of rows and two sums of row hashes that do not depend on their order."""
    columns = sorted(c for c in df.columns if c != by)
    told = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]  # nulls leave a hash as it is
    row = F.xxhash64(*told)
    return df.groupBy(by).agg(F.count("*").alias("_n"), F.sum(row.cast("decimal(38,0)")).alias("_sum"), F.bit_xor(row).alias("_xor"))


def differing_days(table: DataFrame, copy: DataFrame, date_column: str) -> list[str]:
    """Days of the table whose rows the copy does not hold exactly; a day that only the copy has is of an earlier archive."""
    kept = checksums(copy, date_column).select(F.col(date_column).alias("_day"), *[F.col(c).alias(f"{c}_") for c in ("_n", "_sum", "_xor")])
    both = checksums(table, date_column).join(kept, F.col(date_column).eqNullSafe(F.col("_day")), "left")
    same = F.lit(True)
    for c in ("_n", "_sum", "_xor"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    # one row per day that differs
    return sorted(str(r[0]) for r in both.where(~same).select(date_column).collect())


def _forget_archived(spark: SparkSession, table: str) -> None:
    """Drops catalog entries of archived days, in statements of many partitions."""
    mark = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}.get(ARCHIVED)
    if not mark:
        return
    date_column, before = mark.split("=", 1)
    old = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():  # catalog entries, not data
        spec = dict(part.split("=", 1) for part in row[0].split("/"))
        if spec[date_column] < before:
            old.append(f"PARTITION ({_partition_sql(spec)})")
    for i in range(0, len(old), 500):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(old[i:i + 500])}")


def compact_partition(spark: SparkSession, table: str, spec: dict[str, str], new_path: str,
                      file_bytes: int = 128 * 2 ** 20, files: int | None = None) -> None:
    """Rewrites one partition into files of about ``file_bytes``, or into exactly ``files``, and points the partition to them.

    The number follows from the size of the files that are there, as rows in a shuffle are several times larger. A file
    has one writer, which streams its rows and holds one row group.
    """
    rows = spark.table(table).where(partition_filter(spec))
    if files is None:
        stored = rows.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
        files = max(1, -(-(stored or 0) // file_bytes))
    rows.drop(*spec).repartition(files).write.mode("errorifexists").parquet(new_path)
    spark.sql(f"ALTER TABLE {table} PARTITION ({_partition_sql(spec)}) SET LOCATION '{new_path}'")
    spark.sql(f"REFRESH TABLE {table}")


def refresh(spark: SparkSession, table: str, statistics: bool = True) -> None:
    """Finds new partitions, leaves archived ones out, and renews the statistics the optimizer uses."""
    spark.sql(f"MSCK REPAIR TABLE {table}")
    _forget_archived(spark, table)
    spark.sql(f"REFRESH TABLE {table}")
    if statistics:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def files_since(df: DataFrame, modified_after: str) -> DataFrame:
    """Rows of the input files changed after a point in time; file pruning happens on file metadata."""
    return df.where(F.col("_metadata.file_modification_time") > F.lit(modified_after).cast("timestamp"))


def input_present(df: DataFrame) -> bool:
    return not df.isEmpty()

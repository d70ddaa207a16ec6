"""Table statistics: rows and bytes per stored table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firelog.functions.sizes import size_pretty


def file_stats(spark: SparkSession, name: str, path: str) -> DataFrame:
    """``(name, row_count, size_bytes)`` of one Parquet table in one scan.

    Rows are counted per file together with the file's size from the
    scan's ``_metadata``; the per-file rows are summed. Reads no data
    columns.
    """
    df = spark.read.parquet(path)
    per_file = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).groupBy("file").agg(F.count("*").alias("rows"), F.max("bytes").alias("bytes"))
    return per_file.agg(
        F.lit(name).alias("name"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("size_bytes"),
    )


def table_stats(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``(name, row_count, size_bytes, size)`` per table, largest first.

    Row counts are exact (not a planner estimate); ``size`` is the
    human-readable form of the bytes.
    """
    parts = [file_stats(spark, n, p) for n, p in tables.items()]
    allt = reduce(DataFrame.unionByName, parts)
    return allt.withColumn("size", size_pretty(F.col("size_bytes"))).orderBy(
        F.col("size_bytes").desc(), F.col("name")
    )


def database_size(stats: DataFrame) -> DataFrame:
    """One row: total bytes of all tables and its readable form."""
    total = stats.agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("size_bytes"))
    return total.withColumn("database_size", size_pretty(F.col("size_bytes")))

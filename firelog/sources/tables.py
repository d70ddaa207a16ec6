"""Stored tables: the geo table, provider answers, JSON out; the log store's reads (see ``sources.store``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.session import path_exists
from firelog.sources.store import read_day_index, read_log_store

__all__ = ["read_day_index", "read_geo_answers", "read_geo_table", "read_log_store", "write_geo_table", "write_json"]


def read_geo_table(spark: SparkSession, path: str | None) -> DataFrame:
    """The geo table; an empty one if ``path`` is None. A path that does not exist is an error."""
    if path is None:
        return spark.createDataFrame([], S.GEO_SCHEMA)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"geo table not found: {path}")
    return spark.read.schema(S.GEO_SCHEMA).parquet(path)


def write_geo_table(geo: DataFrame, path: str) -> None:
    """Write a new version of the geo table (``path`` must not be an input)."""
    geo.select(*S.GEO_COLUMNS).sortWithinPartitions("ip_address").write.mode("errorifexists").parquet(path)


def read_geo_answers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Provider answers ``(ip, status_code, body)`` from Parquet or JSON lines."""
    reader = spark.read if fmt == "parquet" else spark.read.schema(S.GEO_ANSWER_SCHEMA)
    return reader.format(fmt).load(path).select("ip", F.col("status_code").cast("int"), "body")


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Any result as JSON lines (one object per row)."""
    df.write.mode(mode).json(path)

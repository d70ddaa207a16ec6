"""Report jobs over the stored tables (log store + current geo table).

The store side is restricted to the requested days by partition pruning before
any aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators import reads as R
from firelog.operators import report as RP
from firelog.session import configure
from firelog.sources import geo_store as GS
from firelog.sources import tables as TB


def _store(spark: SparkSession, store_path: str, first_day: str | None, last_day: str | None) -> DataFrame:
    store = TB.read_log_store(spark, store_path)
    if store is None:
        raise FileNotFoundError(store_path)
    if first_day:
        store = store.where(F.col(S.LOG_PARTITION) >= F.lit(first_day).cast("date"))
    if last_day:
        store = store.where(F.col(S.LOG_PARTITION) <= F.lit(last_day).cast("date"))
    return store


def ip_summary_report(spark: SparkSession, store_path: str, geo_path: str,
                      first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Per-day, per-address summary (see ``report.ip_summary``)."""
    configure(spark)
    geo = TB.read_geo_table(spark, geo_path)
    return RP.ip_summary(_store(spark, store_path, first_day, last_day), geo)


def attack_trend_report(spark: SparkSession, store_path: str, geo_path: str,
                        first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Flagged rows per day and country."""
    configure(spark)
    geo = TB.read_geo_table(spark, geo_path)
    return RP.attack_trend(_store(spark, store_path, first_day, last_day), geo)


def enriched_logs_report(spark: SparkSession, store_path: str, geo_path: str,
                         first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Log rows with the location of their source address."""
    configure(spark)
    geo = TB.read_geo_table(spark, geo_path)
    return RP.enriched_logs(_store(spark, store_path, first_day, last_day), geo)


def logs_page(spark: SparkSession, store_path: str, limit: object = None, offset: object = None) -> DataFrame:
    """One page of the stored log, newest first, scanning only the newest days
    (found from the store's day index when the ingest job wrote one)."""
    configure(spark)
    return R.logs_page(_store(spark, store_path, None, None), limit, offset, prune_days=True,
                       day_counts=TB.read_day_index(spark, store_path))


def logs_page_after(spark: SparkSession, store_path: str, after: dict | None = None, limit: object = None) -> DataFrame:
    """The rows of the stored log that follow a key, newest first, with their keys (see ``reads.logs_page_after``)."""
    configure(spark)
    return R.logs_page_after(_store(spark, store_path, None, None), after, limit, TB.read_day_index(spark, store_path))


def geo_lookup(spark: SparkSession, geo_path: str, ip: str) -> DataFrame:
    """Attributes of one address from the stored geo table, bucketed or one version's files."""
    configure(spark)
    if GS.exists(spark, geo_path):
        return GS.lookup(spark, geo_path, ip)
    return R.geo_lookup(TB.read_geo_table(spark, geo_path), ip)

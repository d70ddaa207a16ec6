"""Summaries kept up to date with the log store: addresses seen, and frequent addresses per day.

Every batch leaves its own share of each summary, in a folder with its id next
to its rows; the store's ledger commits them together, so a replayed batch
counts once and an uncommitted one not at all. A read merges the shares of the
committed batches, which are as many rows as a batch has addresses, not the
store's rows::

    seen/batch=<batch>/     (source_ip, first_seen, last_seen, events): minimum, maximum, sum
    frequent/batch=<batch>/ (log_date, source_ip, events, lost): counters, at most ``counters`` a day

``frequent`` holds Misra-Gries summaries: the counts of a day, less the
``counters + 1``-th largest of them, as far as they stay above 0; ``lost`` is
what was taken off. Merged summaries are added and cut again. A count is too
small by at most the sum of ``lost``, which is below the day's rows divided by
``counters + 1``: an address with more rows than that is among the counters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators.report import first_last_seen
from firelog.sources import store as ST

SEEN, FREQUENT = "seen", "frequent"
COUNTERS = 1000


def merge_seen(shares: DataFrame) -> DataFrame:
    """Shares of ``first_last_seen`` as one."""
    return shares.groupBy("source_ip").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
                                           F.sum("events").cast("bigint").alias("events"))


def cut_counters(counts: DataFrame, counters: int = COUNTERS, group: str = S.LOG_PARTITION, item: str = "source_ip") -> DataFrame:
    """``(group, item, events, lost)``: counts of distinct items cut to ``counters`` a group.

    The input's ``lost`` (of its summaries, one value a group) is carried on.
    Only the first ``counters + 1`` of a group in order are needed: ranks are
    limited per task before the shuffle.
    """
    order = Window.partitionBy(group).orderBy(F.desc("events"), item)
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= counters + 1)
    off = F.coalesce(F.max(F.when(F.col("place") == counters + 1, F.col("events"))).over(Window.partitionBy(group)), F.lit(0))
    cut = top.withColumn("off", off).withColumn("events", F.col("events") - F.col("off"))
    # a group whose counters are all gone keeps what was lost in one row without item
    first = F.col("place") == 1
    return cut.where((F.col("events") > 0) | first).select(
        group, F.when(F.col("events") > 0, F.col(item)).alias(item), "events", (F.col("lost") + F.col("off")).alias("lost"))


def day_counters(store: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Misra-Gries summary of each day's source addresses."""
    counts = store.groupBy(S.LOG_PARTITION, "source_ip").agg(F.count(F.lit(1)).alias("events"))
    return cut_counters(counts.withColumn("lost", F.lit(0).cast("bigint")), counters)


def merge_counters(shares: DataFrame, counters: int = COUNTERS, of_share: str = ST.BATCH, group: str = S.LOG_PARTITION) -> DataFrame:
    """Summaries of several shares (told apart by ``of_share``) as one per group."""
    lost = (shares.groupBy(group, of_share).agg(F.max("lost").alias("lost")).groupBy(F.col(group).alias("l_group"))
            .agg(F.sum("lost").alias("lost")))
    added = shares.where(F.col("source_ip").isNotNull()).groupBy(group, "source_ip").agg(F.sum("events").alias("events"))
    every = lost.join(added, added[group].eqNullSafe(lost["l_group"]), "left")
    return cut_counters(every.select(F.col("l_group").alias(group), "source_ip", F.coalesce("events", F.lit(0)).alias("events"), "lost"),
                        counters, group)


def write_share(spark: SparkSession, store_path: str, path: str, batch: str, counters: int = COUNTERS) -> None:
    """A batch's share of each summary, from the rows that it wrote."""
    rows = ST.written_rows(spark, store_path, batch)
    first_last_seen(rows).write.mode("overwrite").parquet(f"{path}/{SEEN}/{ST.BATCH}={batch}")
    day_counters(rows, counters).write.mode("overwrite").parquet(f"{path}/{FREQUENT}/{ST.BATCH}={batch}")


def merge_shares(spark: SparkSession, store_path: str, path: str, batch: str, old: list[str], counters: int = COUNTERS) -> None:
    """The shares of replaced batches as the share of the batch that replaces them."""
    of = lambda kind: spark.read.option("basePath", f"{path}/{kind}").parquet(*(f"{path}/{kind}/{ST.BATCH}={b}" for b in old))
    merge_seen(of(SEEN)).write.mode("overwrite").parquet(f"{path}/{SEEN}/{ST.BATCH}={batch}")
    merge_counters(of(FREQUENT), counters).write.mode("overwrite").parquet(f"{path}/{FREQUENT}/{ST.BATCH}={batch}")


def _shares(spark: SparkSession, store_path: str, path: str, kind: str) -> DataFrame:
    live = ST.committed(spark, store_path).select(F.collect_set(ST.BATCH)).scalar()
    return spark.read.option("basePath", f"{path}/{kind}").parquet(f"{path}/{kind}").where(F.array_contains(live, F.col(ST.BATCH)))


def seen_addresses(spark: SparkSession, store_path: str, path: str) -> DataFrame:
    """First and last time and rows of every stored address, without reading the store."""
    return merge_seen(_shares(spark, store_path, path, SEEN))


def frequent_by_day(spark: SparkSession, store_path: str, path: str, counters: int = COUNTERS) -> DataFrame:
    """``(log_date, source_ip, events, lost)``: the frequent addresses of each day; the true count lies in [events, events + lost]."""
    merged = merge_counters(_shares(spark, store_path, path, FREQUENT), counters)
    return merged.where(F.col("source_ip").isNotNull())


def frequent_sources(spark: SparkSession, store_path: str, path: str, one_in: int, counters: int = COUNTERS) -> DataFrame:
    """``(source_ip, events)`` of every address with more than one in ``one_in`` of all stored rows, ``one_in <= counters``.

    The days' summaries, merged, name all of them (and few others), so only
    their rows are counted in the store.
    """
    if one_in > counters:
        raise ValueError(f"summaries of {counters} counters cannot tell addresses of less than one row in {counters}")
    whole = F.lit(0).alias("whole")
    days = merge_counters(_shares(spark, store_path, path, FREQUENT), counters)
    merged = merge_counters(days.select(whole, "source_ip", "events", "lost", S.LOG_PARTITION), counters, S.LOG_PARTITION, "whole")
    named = merged.where(F.col("source_ip").isNotNull()).select("source_ip")
    total = seen_addresses(spark, store_path, path).select(F.sum("events")).scalar()
    counts = ST.read_log_store(spark, store_path).join(named, "source_ip", "left_semi").groupBy("source_ip").agg(F.count(F.lit(1)).alias("events"))
    return counts.where(F.col("events") * one_in > total)

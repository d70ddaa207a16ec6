"""Threat score of source addresses from the log store and an intelligence table.

The intelligence table holds ``(ip_address, weight)``: how strongly a feed
suspects an address. An address may be listed several times; its largest
weight counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators.joins import join_dimension

# The score: 25 per log level, one per event up to 20, the feed's weight; 100 at most.
LEVEL_POINTS = 25
EVENT_POINTS_LIMIT = 20
MAX_SCORE = 100
MALICIOUS_FROM = 70


def log_level(reason: F.Column) -> F.Column:
    """2 for intrusions, 1 for scans and malformed packets, else 0."""
    return (F.when(reason.isin(*S.LEVEL_HIGH_REASONS), 2)
            .when(reason.isin(*S.LEVEL_MEDIUM_REASONS), 1)
            .otherwise(0))


def threat_score(store: DataFrame, intelligence: DataFrame) -> DataFrame:
    """``(source_ip, events, listed, threat_score, malicious)``, one row per source address.

    The store is aggregated per address before the join, so a hot address
    costs one row per task. A null weight counts as 0.
    """
    per_ip = store.groupBy("source_ip").agg(
        F.count("*").alias("events"), F.max(log_level(F.col("reason"))).alias("_level"))
    feed = (intelligence.where(F.col("ip_address").isNotNull()).groupBy(F.col("ip_address").alias("source_ip"))
            .agg(F.coalesce(F.max("weight"), F.lit(0)).cast("bigint").alias("_weight")))
    points = (F.col("_level") * LEVEL_POINTS + F.least("events", F.lit(EVENT_POINTS_LIMIT))
              + F.coalesce("_weight", F.lit(0)))
    score = F.least(points, F.lit(MAX_SCORE)).cast("bigint")
    return join_dimension(per_ip, feed, "source_ip", "left").select(
        "source_ip", "events", F.col("_weight").isNotNull().alias("listed"),
        score.alias("threat_score"), (score >= MALICIOUS_FROM).alias("malicious"))

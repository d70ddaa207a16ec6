"""Reports: run counters, enriched logs, per-address summaries, trends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators.joins import join_dimension
from firelog.operators.threat import log_level

# Order of the run counters in the final summary.
RUN_METRICS = (
    "lines_read", "flagged", "benign", "malformed", "inserted", "errors",
    "geo_candidates", "geo_queued", "geo_completed", "geo_errors", "processed", "duplicates",
)


def _metric(df: DataFrame, **aggs) -> DataFrame:
    """Single-row aggregates as ``(metric, value)`` rows."""
    one = df.agg(*[F.coalesce(a, F.lit(0)).cast("bigint").alias(k) for k, a in aggs.items()])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in aggs
    ])).alias("m")).select("m.metric", "m.value")


def run_summary(parsed: DataFrame | dict[str, int], rows: DataFrame, new_rows: DataFrame,
                fetched: DataFrame | None = None) -> DataFrame:
    """``(metric, value)`` counters of one run, in summary order.

    ``parsed``: all lines with ``line_class``, or their counts by class as
    they were observed; ``rows``: flagged lines as
    store rows with ``reject_reason``; ``new_rows``: rows inserted;
    ``fetched``: geo lookups with ``geo_error``. Identities: lines_read =
    malformed + benign + flagged; flagged = processed = inserted + errors +
    duplicates; geo_candidates = geo_queued (still waiting) + geo_completed +
    geo_errors.
    """
    cls = F.col("line_class")
    if isinstance(parsed, dict):
        told = rows.sparkSession.createDataFrame(list(parsed.items()), "metric string, value bigint")
    else:
        told = _metric(parsed, lines_read=F.count("*"), flagged=F.count_if(cls == "flagged"),
                       benign=F.count_if(cls == "benign"), malformed=F.count_if(cls == "malformed"))
    parts = [
        told,
        _metric(new_rows, inserted=F.count("*")),
        _metric(rows, errors=F.count_if(F.col("reject_reason").isNotNull()),
                processed=F.count("*"), accepted_=F.count_if(F.col("reject_reason").isNull())),
    ]
    if fetched is not None:
        err = F.col("geo_error")
        parts.append(_metric(fetched, geo_candidates=F.count("*"), geo_completed=F.count_if(err.isNull()),
                             geo_errors=F.count_if(err.isNotNull())))
    allm = reduce(DataFrame.unionByName, parts)
    base = [m for m in RUN_METRICS if m not in ("duplicates", "geo_queued")] + ["accepted_"]
    wide = _pivot(allm, base)
    dup = (F.col("accepted_") - F.col("inserted")).alias("duplicates")
    waiting = (F.col("geo_candidates") - F.col("geo_completed") - F.col("geo_errors")).alias("geo_queued")
    wide = wide.select("*", dup, waiting)
    names = [m for m in RUN_METRICS if m in wide.columns]
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(m).alias("metric"), F.col(m).alias("value"))
        for i, m in enumerate(names)
    ])).alias("m")).select("m.ord", "m.metric", "m.value")


def _pivot(summary: DataFrame, metrics: list[str]) -> DataFrame:
    return summary.groupBy().agg(*[
        F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics
    ])


def run_counters_from(summary: DataFrame) -> DataFrame:
    """``(metric, value)`` rows -> one row with a column per metric."""
    return _pivot(summary, list(RUN_METRICS))


def enriched_logs(store: DataFrame, geo: DataFrame) -> DataFrame:
    """Log rows with country, region, city and isp of their source address."""
    dim = geo.select(F.col("ip_address").alias("source_ip"), "country", "region", "city", "isp")
    return join_dimension(store, dim, "source_ip", "left").select(
        *S.LOG_COLUMNS, "country", "region", "city", "isp"
    )


def _joined_sorted_set(c: str) -> F.Column:
    return F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string")), ",")


def ip_summary(store: DataFrame, geo: DataFrame) -> DataFrame:
    """One row per (log date, source address).

    ``frequency`` rows; ``ports_targeted`` ascending distinct destination
    ports; ``log_level`` HIGH if any INTRUSION-DETECTED, MEDIUM if any
    PORTSCAN or MALFORMED-PACKET, else LOW; ``action_taken`` and ``notes``
    the distinct actions and reasons; ``geolocation`` "city, region,
    country" without empty parts, else ``unknown``. Counted first per distinct
    port, action and reason (a hash aggregate that collapses a hot address per
    task and spills), so the sets see distinct values only; then joined to the
    geo table, so the join sees one row per day and address.
    """
    distinct = store.groupBy(F.col(S.LOG_PARTITION).alias("date"), "source_ip", "destination_port", "action", "reason").agg(
        F.count("*").alias("n"))
    agg = distinct.groupBy("date", "source_ip").agg(
        F.sum("n").cast("bigint").alias("frequency"),
        _joined_sorted_set("destination_port").alias("ports_targeted"),
        F.max(log_level(F.col("reason"))).alias("_level"),
        _joined_sorted_set("action").alias("action_taken"),
        _joined_sorted_set("reason").alias("notes"),
    )
    dim = geo.select(F.col("ip_address").alias("source_ip"), "city", "region", "country")
    j = join_dimension(agg, dim, "source_ip", "left")
    place = F.concat_ws(", ", *[F.when(F.col(c) != "", F.col(c)) for c in ("city", "region", "country")])
    return j.select(
        "date", "source_ip", "frequency", "ports_targeted",
        F.when(F.col("_level") == 2, "HIGH").when(F.col("_level") == 1, "MEDIUM").otherwise("LOW").alias("log_level"),
        "action_taken",
        F.when(place == "", "unknown").otherwise(place).alias("geolocation"),
        "notes",
    )


def first_last_seen(store: DataFrame) -> DataFrame:
    """First and last timestamp and number of rows per source address."""
    return store.groupBy("source_ip").agg(
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.count("*").alias("events"),
    )


def top_sources(store: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent source addresses (ties by address)."""
    counts = store.groupBy("source_ip").agg(F.count("*").alias("events"))
    return counts.orderBy(F.col("events").desc(), F.col("source_ip")).limit(k)


def top_ports(store: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most targeted destination ports (ties by port)."""
    counts = store.groupBy("destination_port").agg(F.count("*").alias("events"))
    return counts.orderBy(F.col("events").desc(), F.col("destination_port")).limit(k)


def country_or_unknown() -> F.Column:
    return F.when(F.coalesce(F.col("country"), F.lit("")) == "", "unknown").otherwise(F.col("country"))


def trend_by_window(store: DataFrame, geo: DataFrame, width: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Flagged rows per time window and country: ``(window_start, country, events)``.

    With ``delay`` only the windows that end at or before the last time less
    the delay: those that a stream with this watermark has closed. Counted per
    (window, address) before the geo join.
    """
    timed = store.select(F.col("timestamp").cast("timestamp").alias("event_time"), "source_ip")
    per_ip = timed.groupBy(F.window("event_time", width).alias("w"), "source_ip").agg(F.count(F.lit(1)).alias("n"))
    if delay:
        last = timed.select(F.date_trunc("millisecond", F.max("event_time"))).scalar()
        per_ip = per_ip.where(F.col("w.end") <= last - F.expr(f"interval {delay}"))
    dim = geo.select(F.col("ip_address").alias("source_ip"), "country")
    placed = join_dimension(per_ip, dim, "source_ip", "left")
    counts = placed.groupBy("w", country_or_unknown().alias("country")).agg(F.sum("n").cast("bigint").alias("events"))
    return counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "country", "events")


def attack_trend(store: DataFrame, geo: DataFrame) -> DataFrame:
    """Flagged rows per day and country (``unknown`` when not located).

    Pre-aggregated per (day, address) before the geo join.
    """
    per_ip = store.groupBy(S.LOG_PARTITION, "source_ip").agg(F.count("*").alias("n"))
    dim = geo.select(F.col("ip_address").alias("source_ip"), "country")
    j = join_dimension(per_ip, dim, "source_ip", "left")
    return j.groupBy(F.col(S.LOG_PARTITION).alias("date"), country_or_unknown().alias("country")).agg(
        F.sum("n").cast("bigint").alias("events")
    )

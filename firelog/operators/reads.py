"""Reads over the stores: paged logs, address lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.functions.timestamps import timestamp_text

PAGE_COLUMNS = ("timestamp", "source_ip", "destination_ip", "protocol", "action")


def page_params(limit: object = None, offset: object = None) -> tuple[int, int]:
    """Normalise request parameters: bad or non-positive limit -> 50,
    bad or negative offset -> 0, no upper bound."""

    def to_int(v: object) -> int | None:
        try:
            return int(str(v).strip())
        except (TypeError, ValueError):
            return None

    lim, off = to_int(limit), to_int(offset)
    if lim is None or lim <= 0:
        lim = S.DEFAULT_PAGE_LIMIT
    if off is None or off < 0:
        off = S.DEFAULT_PAGE_OFFSET
    return lim, off


def newest_dates_needed(store: DataFrame, rows_needed: int, day_counts: DataFrame | None = None) -> DataFrame:
    """Store restricted to the newest dates holding the first ``rows_needed`` rows.

    Per-date row counts (one row per stored day) give, newest first, the
    oldest date still needed; the bound is a scalar subquery, so a store
    partitioned by ``log_date`` is pruned at run time to those days. The
    counts come from ``day_counts`` (the store's small day index, see
    ``sources.tables.refresh_day_index``) when given, else from counting the
    store. The running sum is a window over one row per day.
    """
    if day_counts is not None:
        per_day = day_counts.select(S.LOG_PARTITION, F.col("rows").alias("n"))
    else:
        per_day = store.groupBy(S.LOG_PARTITION).agg(F.count("*").alias("n"))
    newer = Window.orderBy(F.col(S.LOG_PARTITION).desc()).rowsBetween(Window.unboundedPreceding, -1)
    cum = per_day.withColumn("before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    cutoff = cum.where(F.col("before") < rows_needed).select(F.min(S.LOG_PARTITION)).scalar()
    return store.where(F.col(S.LOG_PARTITION) >= cutoff)


def logs_page(store: DataFrame, limit: object = None, offset: object = None,
              prune_days: bool = False, day_counts: DataFrame | None = None) -> DataFrame:
    """One page of stored rows, newest first.

    Ties on the timestamp are broken by the rest of the unique key so the
    order is total and pages do not overlap. Planned as a top-k
    (``TakeOrderedAndProject``), never a full sort. ``prune_days`` first
    limits the scan to the newest days that can hold the page (use on a
    stored, date-partitioned table). A NULL action is returned as NULL.
    """
    lim, off = page_params(limit, offset)
    src = newest_dates_needed(store, lim + off, day_counts) if prune_days else store
    ordered = src.orderBy(
        F.col("timestamp").desc(), *[F.col(c).asc() for c in S.LOG_KEY[1:]]
    ).offset(off).limit(lim)
    return ordered.select(
        timestamp_text(F.col("timestamp")).alias("timestamp"), *PAGE_COLUMNS[1:]
    )


def _follows(key: dict) -> Column:
    """Whether a row comes after the row with this unique key: timestamps descend, the rest ascends, null first."""
    def beyond(c: str) -> Column:
        if c == "timestamp":
            return F.col(c) < F.lit(key[c])
        return F.col(c).isNotNull() if key[c] is None else F.col(c) > F.lit(key[c])

    cond = beyond(S.LOG_KEY[-1])
    for c in reversed(S.LOG_KEY[:-1]):
        cond = beyond(c) | (F.col(c).eqNullSafe(F.lit(key[c])) & cond)
    return cond


def logs_page_after(store: DataFrame, after: dict | None = None, limit: object = None,
                    day_counts: DataFrame | None = None) -> DataFrame:
    """The next ``limit`` rows after the row with the unique key ``after`` (None: from the newest), with all key columns.

    The order is that of ``logs_page``; the last row's key asks for the next
    page. What lies before the key is not read: its day and time bound the
    scan from above, and with ``day_counts`` (the store's day index) the
    oldest day that can still be needed bounds it from below, so a page far
    down costs what the first one costs. The key's row need not exist.
    ``after`` holds the timestamp as a ``datetime`` without zone; bad limits
    read as in ``page_params``.
    """
    lim, _ = page_params(limit)
    src = store
    if after is not None:
        day = F.lit(after["timestamp"].date())
        src = store.where((F.col(S.LOG_PARTITION) <= day) & (F.col("timestamp") <= F.lit(after["timestamp"])) & _follows(after))
        if day_counts is not None:
            # the key's own day may be used up: its rows count for nothing
            day_counts = day_counts.where(F.col(S.LOG_PARTITION) <= day).withColumn(
                "rows", F.when(F.col(S.LOG_PARTITION) == day, F.lit(0)).otherwise(F.col("rows")))
    if day_counts is not None:
        src = newest_dates_needed(src, lim, day_counts)
    ordered = src.orderBy(F.col("timestamp").desc(), *[F.col(c).asc() for c in S.LOG_KEY[1:]]).limit(lim)
    return ordered.select(*S.LOG_KEY, "action")


def page_key(row) -> dict:
    """Key of a row of ``logs_page_after``, to ask for what follows it."""
    return {c: row[c] for c in S.LOG_KEY}


def page_text(page: DataFrame) -> DataFrame:
    """Rows of ``logs_page_after`` as ``logs_page`` shows them."""
    return page.select(timestamp_text(F.col("timestamp")).alias("timestamp"), *PAGE_COLUMNS[1:])


GEO_LOOKUP_COLUMNS = ("ip", "country", "region", "city", "isp", "latitude", "longitude")


def _lookup_rows(geo: DataFrame) -> DataFrame:
    text_present = None
    for c in ("country", "region", "city", "isp"):
        cond = F.col(c).isNotNull()
        text_present = cond if text_present is None else (text_present & cond)
    return geo.where(text_present).select(
        F.col("ip_address").alias("ip"),
        "country", "region", "city", "isp",
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
    )


def geo_lookup(geo: DataFrame, ip: str) -> DataFrame:
    """Attributes of one address; empty result = not found.

    A row with any NULL text attribute counts as not found; NULL
    coordinates read as 0. The equality filter reaches the Parquet scan.
    """
    return _lookup_rows(geo.where(F.col("ip_address") == F.lit(ip)))


def geo_lookup_many(geo: DataFrame, ips: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Bulk form: the found rows for a frame of addresses (semi-join)."""
    wanted = ips.select(F.col(ip_col).alias("ip_address")).distinct()
    return _lookup_rows(geo.join(wanted, "ip_address", "left_semi"))

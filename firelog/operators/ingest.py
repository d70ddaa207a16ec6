"""Insert-if-absent of flagged log entries into the log store.

A store row is unique on the six key columns. A batch row is written only if
no stored row and no earlier-processed row of the batch has its key; the
stored row always wins. "Earlier processed" depends on the read order:
``newest`` (default) processes the log from its end, so among copies in one
batch the one furthest down the log wins; ``oldest`` keeps the first copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.functions.timestamps import normalise_timestamp

NUMBER_COLUMNS = ("source_port", "destination_port", "packet_length", "ttl")

# Reject messages.
REJECT_TIMESTAMP = "invalid timestamp"
REJECT_DESTINATION = "invalid destination IP"
REJECT_TIMESTAMP_VALUE = "timestamp out of range"
REJECT_INT_RANGE = "{} out of integer range"


def _in_int_range(c: Column) -> Column:
    return c.between(S.INT_MIN, S.INT_MAX)


def to_store_rows(entries: DataFrame) -> DataFrame:
    """Typed store rows plus ``reject_reason`` (NULL when insertable).

    Input: parsed entries (text timestamp, 64-bit numbers). Rejected: an
    empty/``unknown`` timestamp or destination, a timestamp that is not a
    real date-time, or a number outside the INTEGER range. The timestamp is
    parsed once (own projection) and reused by the checks and ``log_date``.
    """
    with_ts = entries.withColumn("_ts", normalise_timestamp(F.col("timestamp")))
    ts = F.col("_ts")
    reason = (
        F.when(F.col("timestamp").isin("", S.UNKNOWN), F.lit(REJECT_TIMESTAMP))
        .when(F.col("destination_ip").isin("", S.UNKNOWN), F.lit(REJECT_DESTINATION))
        .when(ts.isNull(), F.lit(REJECT_TIMESTAMP_VALUE))
    )
    for c in NUMBER_COLUMNS:
        reason = reason.when(~_in_int_range(F.col(c)), F.lit(REJECT_INT_RANGE.format(c)))
    extra = [c for c in entries.columns if c not in S.LOG_COLUMNS]
    cols = []
    for f in S.LOG_SCHEMA.fields:
        if f.name == "timestamp":
            cols.append(ts.alias("timestamp"))
        elif f.name in NUMBER_COLUMNS:
            cols.append(F.when(_in_int_range(F.col(f.name)), F.col(f.name).cast("int")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return with_ts.select(*extra, *cols, reason.alias("reject_reason"),
                          F.to_date(ts).alias(S.LOG_PARTITION))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull())


def dedupe_batch(rows: DataFrame, order: str = "newest", order_col: str = "line_no") -> DataFrame:
    """One row per key: the first processed copy in ``order``.

    ``max_by``/``min_by`` are ordinary aggregates, so each task reduces its
    copies before the shuffle (a key repeated in a third of the input costs
    one row per task, not a third of the rows in one task).
    """
    if order not in ("newest", "oldest"):
        raise ValueError("order must be 'newest' or 'oldest'")
    pick = F.max_by if order == "newest" else F.min_by
    keys = [*S.LOG_KEY, S.LOG_PARTITION]
    payload = F.struct(*[F.col(c) for c in S.LOG_PAYLOAD], F.col(order_col).alias("_pos"))
    agg = rows.groupBy(*keys).agg(pick(payload, F.col(order_col)).alias("_w"))
    return agg.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in S.LOG_PAYLOAD]).select(
        *S.LOG_COLUMNS, S.LOG_PARTITION
    )


def days_of(batch: DataFrame):
    """The distinct days of a batch as one scalar subquery (an array, one entry per day)."""
    return batch.select(F.collect_set(S.LOG_PARTITION)).scalar()


def restrict_store_to(store: DataFrame, batch: DataFrame) -> DataFrame:
    """Store rows on the dates covered by ``batch`` (runtime partition pruning).

    The days are one scalar subquery, so when ``store`` is partitioned by
    ``log_date`` only the partitions of these very days are read; a stray
    date adds one day, not all between. Use on a materialised batch (a
    subquery re-runs the batch plan).
    """
    return store.where(F.array_contains(days_of(batch), F.col(S.LOG_PARTITION)))


def insert_if_absent(rows: DataFrame, store: DataFrame | None = None, order: str = "newest",
                     order_col: str = "line_no", dedupe: bool = True, buckets: int | None = None) -> DataFrame:
    """New store rows of a batch: within-batch winner, minus keys already stored.

    ``buckets`` is the number of buckets of a store that is bucketed on the
    key: the winners are dealt into as many partitions and meet the stored
    keys where they lie (the date follows from the key's timestamp). Without
    it the anti-join keys equal the dedupe keys, so the deduplicated side
    keeps its hash partitioning and only the store side is shuffled.
    """
    batch = dedupe_batch(rows, order, order_col) if dedupe else rows
    if store is None:
        return batch
    if buckets:
        return batch.repartition(buckets, *S.LOG_KEY).join(store.select(*S.LOG_KEY), list(S.LOG_KEY), "left_anti")
    keys = [*S.LOG_KEY, S.LOG_PARTITION]
    existing = store.select(*keys)
    return batch.join(existing, keys, "left_anti")


def store_rows_from_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Flagged lines as store rows with ``reject_reason``, each step evaluated once.

    Cheap substring test first; the ten regex searches run on the candidates
    only and are fenced; the class filter then drops malformed candidates
    before the timestamp parse and range checks, which are fenced again so
    the reject filters that follow test columns, not expressions.
    """
    from firelog.operators.triage import flagged_candidates, parse_lines

    return store_rows_from_parsed(parse_lines(flagged_candidates(lines, line_col), line_col))


def store_rows_from_parsed(parsed: DataFrame) -> DataFrame:
    """Flagged rows of an already parsed (and fenced or stored) frame of lines,
    for runs that classify every line anyway (counters)."""
    from firelog.operators.fence import fence

    flagged = parsed.where(F.col("line_class") == "flagged").drop("line_class")
    return fence(to_store_rows(flagged))


def ingest(lines: DataFrame, store: DataFrame | None = None, order: str = "newest") -> dict[str, DataFrame]:
    """One batch of lines: frames for every outcome.

    ``rows`` (flagged lines as store rows with ``reject_reason``),
    ``rejected``, ``accepted`` and ``new_rows`` (to append to the store).
    """
    rows = store_rows_from_lines(lines)
    acc = accepted(rows)
    return {
        "rows": rows,
        "rejected": rejected(rows),
        "accepted": acc,
        "new_rows": insert_if_absent(acc, store, order),
    }

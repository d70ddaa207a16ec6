"""Incremental ingest of log files in a folder (Structured Streaming).

Each micro-batch runs the same ingest as the batch job (triage, rejects,
per-key winner, anti-join with the store) under an id of its own, made of the
stream's checkpoint and the batch's number. ``foreachBatch`` is at-least-once:
a batch that is delivered again is found in the store's ledger and not run;
one that failed half way is written anew, and what its first try left is never
read. Rows, rejects and counters therefore appear once. One writer per store
is assumed.

Files are either complete when they appear (rotated or dated segments) or,
with ``follow``, grow: then every batch reads the bytes that were added
(``sources.growing``). Lines are ordered by (file path, place in the file), so
file names must sort in time order. No watermark is used: a key stays unique
for all time, so late lines are always checked against the whole store.
"""

from __future__ import annotations

import hashlib
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firelog.plans.batch import ingest_lines
from firelog.session import configure, scratch_path
from firelog.sources.growing import read_growing_log_stream
from firelog.sources.lines import read_log_line_stream


# Counters kept of the last micro-batches of a stream without end; the totals count all.
KEPT_COUNTERS = 1000


def _number_lines(batch: DataFrame) -> DataFrame:
    line_no = F.struct(F.col("file"), F.col("block"), F.monotonically_increasing_id().alias("pos"))
    return batch.select(line_no.alias("line_no"), "line")


def start_ingest_stream(spark: SparkSession, source_dir: str, store_path: str,
                        checkpoint_location: str | None = None, order: str = "newest",
                        rejects_path: str | None = None, available_now: bool = True,
                        processing_time: str | None = None,
                        max_files_per_trigger: int | None = None,
                        classify_all: bool = True,
                        kept_counters: int | None = KEPT_COUNTERS,
                        follow: bool = False, buckets: int | None = None,
                        summaries_path: str | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops.

    ``checkpoint_location`` defaults to a new folder under the session's
    shared checkpoint folder (``spark.checkpoint.dir``). ``classify_all``,
    ``buckets`` and ``summaries_path`` as in ``firelog.plans.batch.ingest_lines``. ``follow`` reads
    files that grow (``max_files_per_trigger`` does not apply). The query's
    ``firelog_counters`` hold the counters of the last ``kept_counters``
    micro-batches (None: of all), its ``firelog_totals`` the sums over all
    and the number of batches.
    """
    configure(spark)
    ckpt = checkpoint_location or scratch_path(spark, "firelog-stream-ckpt")
    stream = "stream-" + hashlib.sha1(ckpt.rstrip("/").encode()).hexdigest()[:16]
    if follow:
        lines = read_growing_log_stream(spark, source_dir)
    else:
        lines = read_log_line_stream(spark, source_dir, max_files_per_trigger=max_files_per_trigger)
    counters: deque[dict] = deque(maxlen=kept_counters)
    totals: dict[str, int | None] = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        counts, _ = ingest_lines(batch.sparkSession, _number_lines(batch), store_path, order, rejects_path,
                                 classify_all=classify_all, batch=f"{stream}-{batch_id:09d}", buckets=buckets,
                                 summaries_path=summaries_path)
        for name, n in counts.items():
            old = totals.get(name, 0)
            # what a batch did not count has no total
            totals[name] = None if n is None or old is None else old + n
        totals["batches"] += 1
        counts["batch_id"] = batch_id
        counters.append(counts)

    writer = lines.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    q = writer.start()
    q.firelog_counters, q.firelog_totals = counters, totals  # for callers and tests
    return q


def run_ingest_stream(spark: SparkSession, source_dir: str, store_path: str, **kw) -> list[dict]:
    """Process all files present now, wait, return the counters of every batch."""
    q = start_ingest_stream(spark, source_dir, store_path, available_now=True, kept_counters=None, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return list(q.firelog_counters)

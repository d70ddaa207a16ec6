"""Attack trend by event-time windows, as a streaming aggregate.

Flagged lines are parsed as they arrive, repeated keys are dropped while they
can still come (within the watermark), and rows are counted per window and
country of their source address. A window is written once, when the watermark
has passed its end: its state is dropped and lines that come later than the
delay are not counted. ``operators.report.trend_by_window`` is the same
aggregate over stored rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firelog import schemas as S
from firelog.operators import ingest as I
from firelog.operators.joins import join_dimension
from firelog.operators.report import country_or_unknown
from firelog.session import configure, scratch_path
from firelog.sources.growing import read_growing_log_stream
from firelog.sources.lines import read_log_line_stream

DELAY = "1 day"


def windowed_counts(lines: DataFrame, geo: DataFrame, width: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """``(window_start, country, events)`` of streaming ``lines``."""
    rows = I.accepted(I.store_rows_from_lines(lines))
    # the clock of the log is the zone-less wall clock, read as UTC
    timed = rows.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", delay)
    once = timed.dropDuplicatesWithinWatermark(list(S.LOG_KEY))
    dim = geo.select(F.col("ip_address").alias("source_ip"), "country")
    placed = join_dimension(once.select("event_time", "source_ip"), dim, "source_ip", "left")
    counts = placed.groupBy(F.window("event_time", width).alias("w"), country_or_unknown().alias("country")).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "country", "events")


def start_trend_stream(spark: SparkSession, source_dir: str, out_path: str, geo: DataFrame, width: str = "1 hour", delay: str = DELAY,
                       checkpoint_location: str | None = None, follow: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Append closed windows to the Parquet folder ``out_path``; without ``processing_time`` what is there is processed and the stream stops."""
    configure(spark)
    lines = read_growing_log_stream(spark, source_dir) if follow else read_log_line_stream(spark, source_dir)
    writer = (windowed_counts(lines.select("line"), geo, width, delay).writeStream.outputMode("append").format("parquet").option("path", out_path)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "firelog-trend-ckpt")))
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()


def run_trend_stream(spark: SparkSession, source_dir: str, out_path: str, geo: DataFrame, **kw) -> DataFrame:
    """Process what is there, wait, and return all windows closed so far."""
    q = start_trend_stream(spark, source_dir, out_path, geo, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema("window_start timestamp_ntz, country string, events bigint").parquet(out_path)

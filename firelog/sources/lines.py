"""Log line sources: newline-separated text files, in file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A longer line does not fit a 64 KiB line buffer.
MAX_LINE_BYTES = 64 * 1024 - 1


def _ordinal(df: DataFrame) -> Column:
    """Orderable position of a line: (file path, block start, id in block).

    Within one file block lines are read sequentially by one task, so the
    monotonically increasing id follows file order there; across blocks the
    block start and across files the path decide. Files must therefore be
    named so that their names sort in time order (dated segments, rotated
    logs with zero-padded numbers).
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def lines_from_text(df: DataFrame, max_line_bytes: int | None = MAX_LINE_BYTES,
                    long_lines: str = "keep") -> DataFrame:
    """``value`` of a text scan -> ``line`` with one trailing ``\\r`` removed.

    ``long_lines='keep'`` keeps lines of any length; ``'fail'`` aborts the
    job on a line longer than ``max_line_bytes`` (a line reader with a fixed
    buffer stops there).
    """
    value = F.col("value")
    line = F.when(value.endswith("\r"), value.substr(F.lit(1), F.length(value) - 1)).otherwise(value)
    if max_line_bytes is not None and long_lines == "fail":
        line = F.when(
            F.octet_length(line) > max_line_bytes,
            F.raise_error(F.lit(f"log line longer than {max_line_bytes} bytes")),
        ).otherwise(line)
    elif long_lines not in ("fail", "keep"):
        raise ValueError("long_lines must be 'fail' or 'keep'")
    return df.select(line.alias("line"), *[c for c in df.columns if c != "value"])


def read_log_lines(spark: SparkSession, path: str | list[str], spread: int | None = None, **kw) -> DataFrame:
    """Batch scan of log text: ``(line_no STRUCT, line STRING)``.

    Lines are split on ``\\n`` only (a ``\\r`` before it is dropped), empty
    lines are kept. ``line_no`` orders lines as they appear in the files.
    ``spread`` deals the lines out to so many tasks by their position, for
    input that cannot be split (a gzip'd log); by default nothing is shuffled.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("lineSep", "\n").text(paths)
    with_no = raw.select(_ordinal(raw).alias("line_no"), "value")
    if spread:
        with_no = with_no.repartition(spread, "line_no")
    return lines_from_text(with_no, **kw).select("line_no", "line")


def read_log_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                         **kw) -> DataFrame:
    """Streaming scan of log text files arriving in ``path``.

    Each file must be complete when it appears (a file that grows under the
    same name is not read again). The per-line id is added per micro-batch
    (see ``firelog.streaming``); here the file columns are kept.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.text(path)
    raw = raw.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return lines_from_text(raw, **kw)

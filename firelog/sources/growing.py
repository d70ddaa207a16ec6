"""Streaming source of log files that grow: every line once, from the byte where the last read ended.

An offset names, for each file of a folder, the byte after its last complete
line and a hash of its first line. A later batch reads from there; a file
whose first line changed, or that is shorter than before, was written anew and
is read from its start. A last line without newline waits until it has one.
New bytes are cut into splits, and a split owns the lines that start in it.

Files are opened by path or URI (local and shared folders, ``hdfs://``,
``s3://``, ``gs://``) where the tasks run.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from firelog.sources.lines import lines_from_text

SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20
ROWS = 10_000
SCHEMA = "value string, file string, block bigint"


def open_fs(path: str):
    """File system and inner path of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + unquote(path[5:]).lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def last_line_end(f, size: int) -> int:
    """The byte after the last newline of a file; 0 without any."""
    end = size
    while end > 0:
        start = max(0, end - CHUNK)
        at = f.read_at(end - start, start).rfind(b"\n")
        if at >= 0:
            return start + at + 1
        end = start
    return 0


def first_line_hash(f, end: int) -> str:
    """Hash of the first line (of its first megabyte, if it is longer)."""
    return hashlib.sha1(f.read_at(min(CHUNK, end), 0).split(b"\n", 1)[0]).hexdigest()


def lines_between(f, start: int, a: int, b: int, end: int) -> Iterator[tuple[int, bytes]]:
    """``(byte, line)`` of the lines that start in [a, b); a line starts at ``start`` and one ends at ``end``."""
    at, rest = a, b""
    if a > start:  # the line that runs into the split belongs to the one before
        at = a - 1
        while True:
            raw = f.read_at(min(CHUNK, end - at), at)
            cut = raw.find(b"\n")
            if cut >= 0:
                at, rest = at + cut + 1, raw[cut + 1:]
                break
            if not raw:
                return
            at += len(raw)
    begin = at  # of the line that ``rest`` starts with
    at += len(rest)
    while begin < b:
        cut = rest.find(b"\n")
        if cut >= 0:
            *whole, rest = rest.split(b"\n")
            for line in whole:
                if begin >= b:
                    return
                yield begin, line
                begin += len(line) + 1
            continue
        raw = f.read_at(min(CHUNK, end - at), at)
        if not raw:
            return
        rest, at = rest + raw, at + len(raw)


@dataclass
class ByteSplit(InputPartition):
    file: str
    start: int
    a: int
    b: int
    end: int


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, folder: str, split_bytes: int):
        self.folder, self.split_bytes = folder, split_bytes

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        from pyarrow import fs as pfs

        fs, inner = open_fs(self.folder)
        ends = {}
        for info in fs.get_file_info(pfs.FileSelector(inner, allow_not_found=True)):
            if info.type == pfs.FileType.File and not info.base_name.startswith(("_", ".")):
                with fs.open_input_file(info.path) as f:
                    end = last_line_end(f, info.size)
                    if end:
                        ends[info.path] = [end, first_line_hash(f, end)]
        return {"files": json.dumps(ends, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[ByteSplit]:
        before, out = json.loads(start["files"]), []
        for path, (stop, head) in sorted(json.loads(end["files"]).items()):
            known, old_head = before.get(path, (0, head))
            begin = known if old_head == head and known <= stop else 0
            out += [ByteSplit(path, begin, a, min(a + self.split_bytes, stop), stop) for a in range(begin, stop, self.split_bytes)]
        return out

    def read(self, partition: ByteSplit):
        import pyarrow as pa

        fs, _ = open_fs(self.folder)
        kind = pa.schema([("value", pa.string()), ("file", pa.string()), ("block", pa.int64())])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([v.decode("utf-8", "replace") for _, v in rows], pa.string()),
                                               pa.array([partition.file] * len(rows), pa.string()), pa.array([at for at, _ in rows], pa.int64())], schema=kind)

        with fs.open_input_file(partition.file) as f:
            rows, held = [], 0
            for row in lines_between(f, partition.start, partition.a, partition.b, partition.end):
                rows.append(row)
                held += len(row[1])
                if len(rows) >= ROWS or held > 8 * CHUNK:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    def commit(self, end: dict) -> None:
        pass


class GrowingLogSource(DataSource):
    """Format ``growing_log``; options ``path`` (a folder) and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingLogReader:
        return GrowingLogReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def read_growing_log_stream(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, **kw) -> DataFrame:
    """Streaming lines of the files in ``path`` with ``file`` and ``block``, the byte at which the line starts.

    Options of ``lines_from_text`` apply. Bytes that are no UTF-8 are read as
    replacement characters.
    """
    spark.dataSource.register(GrowingLogSource)
    raw = spark.readStream.format(GrowingLogSource.name()).option("path", path).option("splitBytes", str(split_bytes)).load()
    return lines_from_text(raw, **kw)

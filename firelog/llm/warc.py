"""WARC archives: written by tasks, read back by byte ranges (operator 13).

Every record is a gzip member of its own. Tasks write archives of about
``ROLL_BYTES`` under names of their own and report them; the reports are
written by Spark's commit protocol, and only reported archives are read, so a
task that is lost or runs twice leaves files that nobody reads.

The reader cuts archives into byte ranges, one row each, dealt out to tasks. A
task looks for the gzip magic inside its range, takes a candidate for a record
only if it decodes to a WARC header and on to its end, and owns the records
that start inside, however far they reach. After a record it goes on at its
end; at the start of its range it may stand inside a record of the range
before, whose bytes may hold a whole archive of their own: what starts before
an earlier range's last record ends is dropped, by one row per range.

Equal payloads of some size are stored once; the others' records revisit it.
The holder of a payload is found from one row per (input partition, digest),
and so told to the rows: no task gathers the copies of one payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firelog.llm.common import small_batches, stored
from firelog.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
ROLL_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
MIN_REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = ("path string, range_start bigint, offset bigint, end bigint, record_type string, record_id string, refers_to string, "
           "url string, payload_bytes bigint, payload_digest string, payload binary")


def _file_system(path: str):
    """File system and inner path of a path or URI that tasks can open."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + unquote(path[5:]).lstrip("/")
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def _clean(text: str) -> str:
    """Header values hold no control characters: percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member; headers without value are left out."""
    head = "".join(f"{k}: {_clean(v)}\r\n" for k, v in headers if v is not None)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode()
    return pack.compress(raw) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def page_record(record_type: str, record_id: str, refers_to: str | None, url: str | None, size: int, digest: str, payload: bytes, date: str) -> bytes:
    """A response with its payload, or a revisit with the headers of the response only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = record_type == "revisit"
    return record_bytes([
        ("WARC-Type", record_type), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", url),
        ("WARC-Profile", SAME_PAYLOAD if revisit else None), ("WARC-Refers-To", f"<{refers_to}>" if revisit else None),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response")], http if revisit else http + payload)


def page_records(pages: DataFrame, min_revisit: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``(record_type, record_id, refers_to, url, size, digest, payload)``, one row per row of ``pages``.

    Of rows with equal payloads of ``min_revisit`` bytes or more the one with
    the largest id is the response (null ids last; of equal rows one), the
    others revisit it. The record id names the page's id (``-`` for null) and
    the row. A null text is an empty payload.
    """
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = stored(pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"),
                               F.octet_length(payload).cast("long").alias("size"), F.sha1(payload).alias("digest"),
                               F.monotonically_increasing_id().alias("rid")), "warc-pages", "zstd")
    record = lambda i, r: F.concat(F.lit("urn:x-page:"), F.coalesce(i.cast("string"), F.lit("-")), F.lit(":"), r.cast("string"))
    narrow = rows.where(F.col("size") >= min_revisit).select("page_id", "digest", "rid", F.shiftright("rid", 33).alias("part"))
    spans = narrow.groupBy("part", "digest").agg(F.max(F.struct("page_id", "rid")).alias("best"), F.count(F.lit(1)).alias("n"))
    spans = stored(spans, "warc-spans")
    holders = spans.groupBy("digest").agg(F.max("best").alias("best"), F.sum("n").alias("n")).where("n > 1")
    told = spans.select("part", "digest").join(holders.select("digest", "best"), "digest")
    revisits = narrow.join(told, ["part", "digest"]).where(F.col("rid") != F.col("best.rid")).select(
        F.col("rid").alias("r_rid"), record(F.col("best.page_id"), F.col("best.rid")).alias("refers_to"))
    again = F.col("refers_to").isNotNull()
    return rows.join(revisits, F.col("rid") == F.col("r_rid"), "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), record(F.col("page_id"), F.col("rid")).alias("record_id"), "refers_to",
        "url", "size", "digest", F.when(~again, F.col("payload")).alias("payload"))


def write_warc(records: DataFrame, folder: str, date: str = DATE, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """The rows of ``page_records`` written as archives under ``folder``: ``(path, records, length)`` of each archive.

    A new archive begins after ``roll_bytes``; each opens with a ``warcinfo``
    record, not counted.
    """
    def run(batches):
        fs, inner = _file_system(folder)
        out, path, n = None, None, 0

        def report():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [n], "length": [size]}, pa.schema(
                [("path", pa.string()), ("records", pa.int64()), ("length", pa.int64())]))

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    fs.create_dir(inner, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, n, size = fs.open_output_stream(f"{inner}/{name}", compression=None), f"{folder}/{name}", 0, 0
                    size += out.write(record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                size += out.write(page_record(r["record_type"], r["record_id"], r["refers_to"], r["url"], r["size"], r["digest"], r["payload"], date))
                n += 1
                if size >= roll_bytes:
                    yield report()
                    out = None
        if out is not None:
            yield report()

    small_batches(records.sparkSession, 200)
    return stored(records.mapInArrow(run, "path string, records bigint, length bigint"), "warc-archives")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length)`` of every ``.warc.gz`` file under ``path``, for archives that others have written."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true").load(path)
            .select("path", "length"))


def decode_member(read, at: int) -> tuple[int, bytes] | None:
    """End and content of the gzip member at ``at`` if it is whole and holds a WARC record, else None.

    ``read(position)`` gives bytes from a position on, none at the end.
    """
    unpack, parts, seen, headed = zlib.decompressobj(31), [], 0, False
    while not unpack.eof:
        raw = read(at)
        if not raw:
            return None
        try:
            part = unpack.decompress(raw)
        except zlib.error:
            return None
        at += len(raw) - len(unpack.unused_data)
        parts.append(part)
        seen += len(part)
        if not headed and seen >= 5:
            parts = [b"".join(parts)]
            if not parts[0].startswith(b"WARC/"):
                return None
            headed = True
    content = b"".join(parts)
    return (at, content) if headed and b"\r\n\r\n" in content else None


def parse_record(content: bytes) -> dict:
    """Named headers of a record in lower case, and its ``block``."""
    head, block = content.split(b"\r\n\r\n", 1)
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    out: dict = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    out["block"] = block[:int(out["content-length"])]
    return out


def members(read, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, end, content)`` of the records that start in a byte range."""
    window, at = b"", start  # bytes from ``at`` on
    while at < end:
        if len(window) < len(MAGIC):
            more = read(at + len(window))
            if not more:
                return
            window += more
            continue
        spot = window.find(MAGIC)
        if spot < 0:
            at, window = at + len(window) - len(MAGIC) + 1, window[1 - len(MAGIC):]
            window += read(at + len(window)) or b""
            if len(window) < len(MAGIC):
                return
            continue
        at, window = at + spot, window[spot:]
        if at >= end:
            return
        first = window

        def ahead(p: int, at: int = at, first: bytes = first) -> bytes:
            return first[p - at:] if p - at < len(first) else read(p)

        found = decode_member(ahead, at)
        if found is None:
            at, window = at + 1, window[1:]
            continue
        yield at, found[0], found[1]
        window = window[found[0] - at:]
        at = found[0]


def _row(path: str, range_start: int, offset: int, end: int, content: bytes, with_payload: bool) -> dict:
    r = parse_record(content)
    bare = lambda v: v and v.strip("<>")
    row = dict(path=path, range_start=range_start, offset=offset, end=end, record_type=r.get("warc-type"), record_id=bare(r.get("warc-record-id")),
               refers_to=bare(r.get("warc-refers-to")), url=r.get("warc-target-uri"), payload_bytes=None, payload_digest=None, payload=None)
    payload = r["block"]
    if r.get("content-type", "").startswith("application/http"):
        head, _, payload = payload.partition(b"\r\n\r\n")
    told = r.get("warc-payload-digest", "")
    told = base64.b32decode(told[5:]).hex() if told.startswith("sha1:") else None
    if row["record_type"] == "revisit":
        # what it would have held: the headers of the response say so
        size = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return row | dict(payload_bytes=size and int(size[1]), payload_digest=told)
    digest = hashlib.sha1(payload).hexdigest()
    if told is not None and told != digest:
        raise ValueError(f"payload of {row['record_id']} in {path} differs from its digest")
    return row | dict(payload_bytes=len(payload), payload_digest=digest, payload=payload if with_payload else None)


def read_warc(files: DataFrame, with_payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of archives ``(path, length)``: where it lies, type, ids, URL, and its payload's size, SHA-1 (hex) and bytes.

    A revisit has the size and digest of the payload it stands for and no
    bytes; without ``with_payload`` none has. A member that does not decode to
    its end, or to no WARC header, is no record. Missing headers are null.
    """
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)),
                                                                 F.lit(split_bytes).cast("long"))).alias("start"))
    kind = pa.schema([(f.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in _RECORD.split(", ")])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                fs, inner = _file_system(r["path"])
                with fs.open_input_file(inner) as f:
                    rows, held = [], 0
                    for offset, end, content in members(lambda p, f=f: f.read_at(READ_BYTES, p) if p < f.size() else b"", r["start"],
                                                        min(r["start"] + split_bytes, r["length"])):
                        rows.append(_row(r["path"], r["start"], offset, end, content, with_payload))
                        held += len(content) if with_payload else 100
                        if held > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kind)

    tasks = max(1, min(ranges.count(), 100_000))  # a range a task as far as that goes: rows are too small for their size to tell
    found = stored(ranges.repartition(tasks).mapInArrow(run, _RECORD), "warc-records")
    before = Window.partitionBy("path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    reach = (found.groupBy("path", "range_start").agg(F.max("end").alias("last"))
             .select("path", "range_start", F.coalesce(F.max("last").over(before), F.lit(0)).alias("reach")))
    return found.join(reach, ["path", "range_start"]).where(F.col("offset") >= F.col("reach")).drop("reach", "range_start")


def page_id_of(record_id):
    """Page id in a record id of ``page_records``; null for none."""
    return F.expr(f"try_cast(regexp_extract({record_id}, '^urn:x-page:(-?[0-9]+):', 1) AS bigint)")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all pages, written as archives and read back.

    Null and repeated ids stay; an empty table writes nothing; other columns
    are ignored, whatever their names.
    """
    spark = pages.sparkSession
    written = write_warc(page_records(pages), folder or scratch_path(spark, "warc"))
    found = read_warc(written, with_payload=False).where(F.col("record_type").isin("response", "revisit"))
    return found.select(page_id_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        page_id_of("refers_to").alias("refers_to"))

"""The geo table in hash buckets: a merge rewrites the buckets it touches, a lookup opens one.

Layout under the table's path::

    _layout.json                     number of buckets, fixed when the table is made
    _versions/<n>.json               for each bucket the version that holds its rows
    _current                         the version that readers see, switched last
    data/v=<n>/bucket=<b>/part-....parquet

A bucket is the address's crc32 modulo the number of buckets; its rows are one
sorted file. A merge writes its buckets under the next version, then the map
of buckets, then the pointer: readers see all of a merge or nothing, and what
a failed one left is removed by the next. ``remove_old`` deletes buckets that
the current version does not name.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators.geo import upsert_geo
from firelog.operators.reads import geo_lookup, geo_lookup_many
from firelog.session import path_exists, scratch_path
from firelog.sources.files import delete, names, read_small, write_small

# About 100 MB a bucket at ten million addresses a gigabyte and ten billion addresses would be 10,000; an address
# table of the usual size (tens of millions) is well served by this.
DEFAULT_BUCKETS = 64


def _join(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), *parts])


def bucket_of(ip: str, buckets: int) -> int:
    return zlib.crc32(ip.encode()) % buckets


def _bucket(column: str, buckets: int):
    return F.pmod(F.crc32(F.col(column).cast("binary")), F.lit(buckets)).cast("int")


def create(spark: SparkSession, path: str, buckets: int | None = None) -> int:
    """Make the table unless it is there; its number of buckets."""
    told = read_small(spark, _join(path, "_layout.json"))
    if told is not None:
        return json.loads(told)["buckets"]
    n = buckets or DEFAULT_BUCKETS
    write_small(spark, _join(path, "_layout.json"), json.dumps({"buckets": n}))
    return n


def version(spark: SparkSession, path: str) -> int:
    """Number of the version that readers see; 0 for a table without rows."""
    return int(read_small(spark, _join(path, "_current")) or 0)


def _places(spark: SparkSession, path: str, n: int | None = None) -> dict[int, int]:
    """Version that holds each bucket that has rows."""
    n = version(spark, path) if n is None else n
    return {int(b): v for b, v in json.loads(read_small(spark, _join(path, "_versions", f"{n}.json")) or "{}").items()}


def _read(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    places = _places(spark, path)
    folders = [_join(path, "data", f"v={v}", f"bucket={b}") for b, v in sorted(places.items()) if buckets is None or b in set(buckets)]
    return spark.read.schema(S.GEO_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], S.GEO_SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the current version."""
    return _read(spark, path)


def read_of(spark: SparkSession, path: str, ips: DataFrame, ip_col: str = "ip") -> DataFrame:
    """The rows of the buckets in which the addresses of ``ips`` would lie."""
    n = create(spark, path)
    wanted = [r[0] for r in ips.select(_bucket(ip_col, n)).distinct().collect()]  # one value per bucket at most
    return _read(spark, path, wanted)


def lookup(spark: SparkSession, path: str, ip: str) -> DataFrame:
    """Attributes of one address, from the one file of its bucket."""
    return geo_lookup(_read(spark, path, [bucket_of(ip, create(spark, path))]), ip)


def lookup_many(spark: SparkSession, path: str, ips: DataFrame, ip_col: str = "ip") -> DataFrame:
    """Attributes of all addresses of ``ips`` that are found."""
    return geo_lookup_many(read_of(spark, path, ips, ip_col), ips, ip_col)


def merge(new_rows: DataFrame, path: str, buckets: int | None = None) -> list[int]:
    """Insert or replace rows by address; the buckets that were rewritten.

    Several new rows of an address count as in ``operators.geo.upsert_geo``.
    One writer at a time is assumed.
    """
    spark = new_rows.sparkSession
    n = create(spark, path, buckets)
    staged = scratch_path(spark, "firelog-geo-merge")
    try:
        new_rows.select(*S.GEO_COLUMNS).write.parquet(staged)
        new = spark.read.schema(S.GEO_SCHEMA).parquet(staged)
        touched = sorted(r[0] for r in new.select(_bucket("ip_address", n)).distinct().collect())
        if not touched:
            return []
        current, places = version(spark, path), _places(spark, path)
        folder = _join(path, "data", f"v={current + 1}")
        delete(spark, folder)
        merged = upsert_geo(_read(spark, path, touched), new).withColumn("bucket", _bucket("ip_address", n))
        (merged.repartition(len(touched), "bucket").sortWithinPartitions("bucket", "ip_address")
         .write.partitionBy("bucket").parquet(folder))
        write_small(spark, _join(path, "_versions", f"{current + 1}.json"), json.dumps({**places, **dict.fromkeys(touched, current + 1)}))
        write_small(spark, _join(path, "_current"), str(current + 1))
        return touched
    finally:
        delete(spark, staged)


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the buckets that none of the last ``keep`` versions names; how many went."""
    current = version(spark, path)
    live = {(v, b) for n in range(max(1, current - keep + 1), current + 1) for b, v in _places(spark, path, n).items()}
    gone = 0
    for folder in names(spark, _join(path, "data")):
        v = int(folder.partition("=")[2])
        for sub in names(spark, _join(path, "data", folder)):
            if sub.startswith("bucket=") and (v, int(sub.partition("=")[2])) not in live and v <= current:
                delete(spark, _join(path, "data", folder, sub))
                gone += 1
    return gone


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, _join(path, "_layout.json"))

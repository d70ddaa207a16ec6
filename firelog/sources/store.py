"""The log store: bucketed by the unique key, written in batches that a ledger commits.

Layout under the store's path::

    _layout.json                 number of buckets, fixed when the store is made
    _ledger/<batch>.json         one small file per committed batch
    batch=<batch>/log_date=<day>/part-..._<bucket>...parquet

Rows carry the id of the batch that wrote them. A batch becomes visible when
its ledger file is renamed into place, with its counters and its rows per day;
what a failed batch left is never read and is removed when the batch runs
again. A batch that is delivered twice is found in the ledger and not run.

Files are bucketed on the six key columns, so the insert's anti-join reads the
stored keys bucket by bucket: the batch is dealt into as many buckets, the
stored side is not shuffled. The table is declared in the session's catalog
over the path, which holds all there is to know; nothing depends on a
metastore. ``compact`` rewrites committed batches as one.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firelog import schemas as S
from firelog.session import path_exists
from firelog.sources.files import delete, names, read_small, write_small

BATCH = "batch"
LAYOUT = "_layout.json"
LEDGER = "_ledger"
# Most buckets of a store that is made without saying how many (else the session's shuffle partitions): every batch
# writes a file per bucket and day, so a store of many days and batches wants few, one with large days as many as tasks.
MOST_DEFAULT_BUCKETS = 64
# Rows per output file (~100-200 MB of store rows): a large bucket of one day rolls over to a new file.
MAX_ROWS_PER_FILE = 2_000_000

_SCHEMA = T.StructType([*S.LOG_SCHEMA.fields, T.StructField(BATCH, T.StringType()), T.StructField(S.LOG_PARTITION, T.DateType())])
_LEDGER_SCHEMA = f"{BATCH} string, counters map<string,bigint>, days map<string,bigint>, replaces array<string>"


def _join(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), *parts])


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, _join(path, LAYOUT))


def create(spark: SparkSession, path: str, buckets: int | None = None) -> int:
    """Make the store unless it is there; its number of buckets."""
    told = read_small(spark, _join(path, LAYOUT))
    if told is not None:
        return json.loads(told)["buckets"]
    n = buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_DEFAULT_BUCKETS)
    write_small(spark, _join(path, LAYOUT), json.dumps({"buckets": n, "bucketed_by": list(S.LOG_KEY)}))
    return n


def _table(spark: SparkSession, path: str, buckets: int) -> str:
    """Name of the catalog table over the path, its files listed anew."""
    name = "firelog_store_" + hashlib.sha1(path.rstrip("/").encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _SCHEMA.fields)
        keys = ", ".join(f"`{c}`" for c in S.LOG_KEY)
        # partitions are found by listing the path: batches that other sessions wrote are seen
        conf = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(conf)
        spark.conf.set(conf, "false")
        try:
            location = _join(path).replace("'", "\\'")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({BATCH}, {S.LOG_PARTITION}) "
                      f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'")
        finally:
            spark.conf.set(conf, before)
    spark.catalog.refreshTable(name)
    return name


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``(batch, counters, days, replaces)`` of every committed batch, also of those that a later one replaced."""
    folder = _join(path, LEDGER)
    if not names(spark, folder):
        return spark.createDataFrame([], _LEDGER_SCHEMA)
    return spark.read.schema(_LEDGER_SCHEMA).json(folder)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The ledger rows whose rows are to be read."""
    every = ledger(spark, path)
    gone = every.select(F.explode("replaces").alias(BATCH))
    return every.join(gone, BATCH, "left_anti")


def committed_counters(spark: SparkSession, path: str, batch: str) -> dict[str, int | None] | None:
    """Counters of a committed batch; None if it is not committed."""
    told = read_small(spark, _join(path, LEDGER, f"{batch}.json"))
    return None if told is None else json.loads(told)["counters"]


def batch_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Committed rows with their ``batch``; None where no store was made."""
    if not exists(spark, path):
        return None
    if not any(n.startswith(f"{BATCH}=") for n in names(spark, path)):
        return spark.createDataFrame([], _SCHEMA)  # nothing but empty batches: the path has no partitions to list
    table = spark.table(_table(spark, path, create(spark, path)))
    # one array with an entry per batch: partitions of other batches are not opened
    live = committed(spark, path).select(F.collect_set(BATCH)).scalar()
    return table.where(F.array_contains(live, F.col(BATCH)))


def read_log_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The log store's committed rows, or None if nothing was written yet."""
    rows = batch_rows(spark, path)
    return None if rows is None else rows.drop(BATCH)


def start_batch(spark: SparkSession, path: str, batch: str, buckets: int | None = None, beside: tuple[str, ...] = ()) -> int:
    """Make the store if need be and remove what an earlier try of this batch left, there and in the folders ``beside``."""
    n = create(spark, path, buckets)
    for folder in (path, *beside):
        delete(spark, _join(folder, f"{BATCH}={batch}"))
    return n


def write_rows(rows: DataFrame, path: str, batch: str, max_rows_per_file: int = MAX_ROWS_PER_FILE) -> None:
    """Rows of a batch that is not committed yet, dealt into the store's buckets."""
    spark = rows.sparkSession
    n = create(spark, path)
    out = rows.select(*S.LOG_COLUMNS, F.lit(batch).alias(BATCH), S.LOG_PARTITION).repartition(n, *S.LOG_KEY)
    (out.sortWithinPartitions(S.LOG_PARTITION, "timestamp").write.option("maxRecordsPerFile", max_rows_per_file)
     .insertInto(_table(spark, path, n)))


def written_rows(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """Rows that a batch has written, committed or not."""
    if not path_exists(spark, _join(path, f"{BATCH}={batch}")):
        return spark.createDataFrame([], _SCHEMA)
    return spark.table(_table(spark, path, create(spark, path))).where(F.col(BATCH) == batch)


def commit(spark: SparkSession, path: str, batch: str, counters: dict[str, int | None], replaces: list[str] | None = None) -> None:
    """Make a batch visible: its counters, its rows per day and the batches it replaces, in one renamed file."""
    # no column is read: counts come from the file footers of this batch only
    days = {str(r[0]): r[1] for r in written_rows(spark, path, batch).groupBy(S.LOG_PARTITION).count().collect()}
    write_small(spark, _join(path, LEDGER, f"{batch}.json"), json.dumps(
        {BATCH: batch, "counters": counters, "days": days, "replaces": replaces or []}) + "\n")


def append(rows: DataFrame, path: str, batch: str, counters: dict[str, int | None] | None = None, buckets: int | None = None) -> None:
    """One batch of rows whose keys are not stored: written and committed; nothing if the batch is committed already."""
    spark = rows.sparkSession
    if committed_counters(spark, path, batch) is not None:
        return
    start_batch(spark, path, batch, buckets)
    write_rows(rows, path, batch)
    commit(spark, path, batch, counters or {})


def read_day_index(spark: SparkSession, path: str) -> DataFrame | None:
    """``(log_date, rows)`` per stored day, summed over the ledger; None where no store was made."""
    if not exists(spark, path):
        return None
    per_batch = committed(spark, path).select(F.explode("days").alias("day", "rows"))
    return per_batch.groupBy(F.to_date("day").alias(S.LOG_PARTITION)).agg(F.sum("rows").alias("rows"))


def compact(spark: SparkSession, path: str, batch: str, summaries: str | None = None) -> list[str]:
    """Rewrite all committed rows as one batch, a file per day and bucket; the batches it replaced.

    The shares of these batches in the store's ``summaries`` become one too.

    Readers see the old batches until the new one is committed, and the new
    one from then on. The old files stay for readers that began before;
    ``remove_replaced`` deletes them.
    """
    if not exists(spark, path) or committed_counters(spark, path, batch) is not None:
        return []
    old = sorted(r[0] for r in committed(spark, path).select(BATCH).collect())
    if not old:
        return []
    start_batch(spark, path, batch)
    # read as plain files: a bucketed scan would stand in for the repartition of the write, and then be read unbucketed
    rows = spark.read.schema(_SCHEMA).parquet(path).where(F.col(BATCH).isin(old))
    write_rows(rows, path, batch)
    if summaries:
        from firelog.sources.summaries import merge_shares

        merge_shares(spark, path, summaries, batch, old)
    commit(spark, path, batch, {}, old)
    return old


def remove_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the rows of batches that a committed batch replaced (their ledger entries stay)."""
    gone = sorted(r[0] for r in ledger(spark, path).select(F.explode("replaces")).distinct().collect())
    for batch in gone:
        delete(spark, _join(path, f"{BATCH}={batch}"))
    return gone


def rejects(spark: SparkSession, path: str, store_path: str) -> DataFrame:
    """Rejected lines of the committed batches, each as often as it was read, with their ``batch``."""
    live = ledger(spark, store_path).select(F.collect_set(BATCH)).scalar()
    return spark.read.option("basePath", path).parquet(path).where(F.array_contains(live, F.col(BATCH)))


def write_rejects(rows: DataFrame, path: str, batch: str) -> None:
    """Rejected lines of one batch in a folder of their own: no earlier rejects are read."""
    rows.write.mode("overwrite").parquet(_join(path, f"{BATCH}={batch}"))

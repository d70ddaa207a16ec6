"""Insert validation, rejects, per-key winner and the store-wins rule."""

import datetime as dt

from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators import ingest as I

BASE = ("{ts} SRC=203.0.113.40 DST={dst} PROTO=TCP SPT={spt} DPT=8443 action=DROP reason=PORTSCAN "
        "LEN=212 TTL={ttl}")


def line(ts="2023-07-19T16:42:37Z", dst="198.51.100.77", spt="40112", ttl="57"):
    return BASE.format(ts=ts, dst=dst, spt=spt, ttl=ttl)


def lines_df(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")


def test_valid_insert(spark):
    out = I.ingest(lines_df(spark, [line()]))
    rows = out["new_rows"].collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["timestamp"] == dt.datetime(2023, 7, 19, 16, 42, 37)
    assert (r["source_port"], r["destination_port"], r["ttl"]) == (40112, 8443, 57)
    assert r[S.LOG_PARTITION] == dt.date(2023, 7, 19)


def test_to_store_rows_rejects_unknown_destination(spark):
    entries = spark.createDataFrame(
        [(1, "x", "2023-07-19T16:42:37Z", "203.0.113.40", "unknown", 1, 2, "TCP", "DROP", "PORTSCAN", 3, 4),
         (2, "y", "unknown", "203.0.113.40", "198.51.100.77", 1, 2, "TCP", "DROP", "PORTSCAN", 3, 4)],
        "line_no long, line string, timestamp string, source_ip string, destination_ip string, "
        "source_port long, destination_port long, protocol string, action string, reason string, "
        "packet_length long, ttl long")
    got = {r.line_no: r.reject_reason for r in I.to_store_rows(entries).collect()}
    assert got == {1: "invalid destination IP", 2: "invalid timestamp"}


def test_rejects(spark):
    df = lines_df(spark, [
        line(spt="99999999999"),                  # fits 64 bits, not INTEGER
        line(ts="2024-13-45T00:00:00-05:00"),     # impossible date
        line(spt="99999999999999999999"),         # beyond 64 bits -> 0, accepted
    ])
    out = I.ingest(df)
    rej = {r.line_no: r.reject_reason for r in out["rejected"].collect()}
    assert rej == {0: "source_port out of integer range", 1: "timestamp out of range"}
    acc = out["accepted"].collect()
    assert [r.source_port for r in acc] == [0]


def test_duplicate_winner_depends_on_order(spark):
    # equal wall clock, other offset -> same key; TTL tells which line won
    df = lines_df(spark, [line(ts="2023-07-19T16:42:37-05:00", ttl="1"),
                          line(ts="2023-07-19T16:42:37+01:00", ttl="2")])
    newest = I.ingest(df, order="newest")["new_rows"].collect()
    oldest = I.ingest(df, order="oldest")["new_rows"].collect()
    assert [r.ttl for r in newest] == [2]
    assert [r.ttl for r in oldest] == [1]


def test_store_wins(spark):
    first = I.ingest(lines_df(spark, [line(ttl="7")]))["new_rows"]
    again = I.ingest(lines_df(spark, [line(ttl="8"), line(ts="2025-01-06T00:00:00Z")]), store=first)
    new = again["new_rows"].collect()
    assert len(new) == 1 and new[0]["timestamp"] == dt.datetime(2025, 1, 6)


def test_dedupe_hot_key_partial_aggregation(spark):
    # a single key repeated many times collapses to one row
    df = lines_df(spark, [line(ttl=str(i % 50 + 1)) for i in range(2000)]).repartition(8)
    rows = I.ingest(df, order="newest")["new_rows"].collect()
    assert len(rows) == 1 and rows[0].ttl == 1999 % 50 + 1
    plan = I.ingest(df)["new_rows"]._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_restrict_store_prunes_dates(spark, tmp_dir):
    store = I.ingest(lines_df(spark, [line(ts=f"2025-01-0{d}T00:00:00Z") for d in range(1, 8)]))["new_rows"]
    path = f"{tmp_dir}/store"
    store.write.partitionBy(S.LOG_PARTITION).parquet(path)
    batch = I.ingest(lines_df(spark, [line(ts="2025-01-03T00:00:00Z")]))["accepted"]
    batch_path = f"{tmp_dir}/batch"
    batch.write.parquet(batch_path)
    pruned = I.restrict_store_to(spark.read.parquet(path), spark.read.parquet(batch_path))
    assert pruned.count() == 1
    assert pruned.where(F.col(S.LOG_PARTITION) == "2025-01-03").count() == 1

"""Missing paths, duplicate answers, stray dates, replayed rejects, long lines."""

import re

import pytest
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators import geo as G
from firelog.operators import ingest as I
from firelog.sources import store as SR
from firelog.sources import tables as TB
from firelog.sources.lines import read_log_lines


def test_missing_geo_table_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        TB.read_geo_table(spark, str(tmp_path / "nowhere"))
    assert TB.read_geo_table(spark, None).count() == 0


def test_one_geo_row_per_address(spark):
    cands = spark.createDataFrame([("198.51.100.7",)], "ip string")
    body = '{"country":"Utopia","regionName":"R","city":"%s","isp":"I","lat":1.0,"lon":2.0}'
    answers = spark.createDataFrame([("198.51.100.7", 500, "zzz"), ("198.51.100.7", 200, body % "A"),
                                     ("198.51.100.7", 200, body % "B")], "ip string, status_code int, body string")
    new = G.as_geo_rows(G.fetch(cands, answers), "2024-02-01")
    old = new.withColumn("city", F.lit("old")).withColumn("last_updated", F.lit("2024-01-01").cast("timestamp_ntz"))
    merged = G.upsert_geo(old.unionByName(old), new).collect()
    assert [r["city"] for r in merged] == ["B"]


def test_stray_date_reads_only_its_own_days(spark, tmp_path):
    store = str(tmp_path / "store")
    days = spark.sql("select explode(sequence(date'2025-01-01', date'2025-01-07')) as log_date").withColumn("x", F.lit(1))
    days.write.partitionBy(S.LOG_PARTITION).parquet(store)
    batch = spark.sql("select explode(array(date'1970-01-01', date'2025-01-07')) as log_date")
    got = I.restrict_store_to(spark.read.parquet(store), batch)
    assert [str(r[0]) for r in got.select("log_date").collect()] == ["2025-01-07"]
    assert re.search(r"PartitionFilters: \[[^\n]*array_contains", got._jdf.queryExecution().executedPlan().toString())


def test_rejects_of_a_batch_that_runs_again_are_kept_once(spark, tmp_path):
    path, store = str(tmp_path / "rejects"), str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "a", "bad"), (2, "a", "bad"), (3, "b", "bad")], "line_no int, line string, reject_reason string")
    for _ in range(2):
        SR.write_rejects(rows, path, "one")
    assert SR.rejects(spark, path, store).count() == 0  # not committed yet
    SR.commit(spark, store, "one", {})
    assert sorted(r["line"] for r in SR.rejects(spark, path, store).collect()) == ["a", "a", "b"]


def test_long_line_is_kept_by_default_and_nothing_is_shuffled(spark, tmp_path):
    (tmp_path / "log.txt").write_text("x" * 70_000 + "\nshort\n")
    df = read_log_lines(spark, str(tmp_path / "log.txt"))
    assert df.count() == 2
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_table_statistics_are_those_of_the_file_system(spark):
    import glob
    import os

    import pyarrow.parquet as pq

    from __spark_entry__ import TABLES, _source_tables
    from firelog.operators.stats import database_size, table_stats

    folder = "/root/testdata/sf0.001"
    stats = table_stats(spark, _source_tables(folder))
    got = {r["name"]: (r["row_count"], r["size_bytes"]) for r in stats.collect()}
    files = {t: glob.glob(f"{folder}/{t}.parquet/*.parquet") or [f"{folder}/{t}.parquet"] for t in TABLES}
    assert got == {t: (sum(pq.read_metadata(f).num_rows for f in fs), sum(map(os.path.getsize, fs))) for t, fs in files.items()}
    assert database_size(stats).first()["size_bytes"] == sum(b for _, b in got.values())

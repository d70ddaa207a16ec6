"""Pages after a key."""

import datetime as dt

import pytest

from firelog import schemas as S
from firelog.operators import reads as R

BASE = dt.datetime(2025, 4, 1)


@pytest.fixture(scope="module")
def store(spark):
    rows = []
    for i in range(240):
        ts = BASE + dt.timedelta(hours=i // 6)  # six rows share each timestamp
        rows.append((ts, f"192.0.2.{i % 2}", f"198.51.100.{i % 3}", "TCP", None if i % 6 == 0 else i % 6, 80, "DROP" if i % 5 else None,
                     "PORTSCAN", 60, 64, ts.date()))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.LOG_SCHEMA.fields) + ", log_date date"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def pages(store, limit, **kw):
    out, key = [], None
    while True:
        page = R.logs_page_after(store, key, limit, **kw).collect()
        out += page
        if len(page) < limit:
            return out
        key = R.page_key(page[-1])


def test_pages_after_keys_are_the_whole_order(store):
    whole = [tuple(r) for r in R.page_text(R.logs_page_after(store, None, 1000)).collect()]
    assert whole == [tuple(r) for r in R.logs_page(store, 1000).collect()] and len(whole) == 240
    day_counts = store.groupBy("log_date").count().withColumnRenamed("count", "rows")
    got = pages(store, 37, day_counts=day_counts)
    assert len({R.page_key(r).__repr__() for r in got}) == 240 == len(got)
    assert [r.timestamp for r in got] == sorted((r.timestamp for r in got), reverse=True)
    assert pages(store, 100) == got


def test_a_key_that_is_no_row_and_bad_limits(store):
    after = {"timestamp": BASE + dt.timedelta(hours=2, minutes=30), "source_ip": "x", "destination_ip": "x", "protocol": "x",
             "source_port": 1, "destination_port": None}
    assert [r.timestamp.hour for r in R.logs_page_after(store, after, 7).collect()] == [2] * 6 + [1]
    assert R.logs_page_after(store, after, "nonsense").count() == 18
    first = {**after, "timestamp": BASE - dt.timedelta(days=3)}
    assert R.logs_page_after(store, first, 5).count() == 0


def test_the_scan_is_bounded_on_both_sides(spark, store, tmp_dir):
    path = f"{tmp_dir}/s"
    store.write.partitionBy("log_date").parquet(path)
    days = store.groupBy("log_date").count().withColumnRenamed("count", "rows")
    after = {"timestamp": dt.datetime(2025, 4, 6, 3), "source_ip": "192.0.2.0", "destination_ip": "198.51.100.0", "protocol": "TCP",
             "source_port": 2, "destination_port": 80}
    page = R.logs_page_after(spark.read.parquet(path), after, 20, days)
    assert page.count() == 20
    plan = page._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "log_date" in line)
    assert "<= 2025-04-06" in scan or "<= 20184" in scan, scan
    assert "Subquery" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")] and "LessThanOrEqual(timestamp" in scan
    assert "TakeOrderedAndProject" in plan

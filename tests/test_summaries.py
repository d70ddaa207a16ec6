"""Summaries of the store and the windowed trend."""

import collections
import os
import random

import pytest
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators import report as RP
from firelog.plans import batch as B
from firelog.sources import store as ST
from firelog.sources import summaries as SM
from firelog.streaming.trend_stream import run_trend_stream

LINE = "2025-05-{d:02d}T{h:02d}:{m:02d}:{s:02d}Z fw: action=DROP reason=PORTSCAN SRC={src} DST=203.0.113.5 LEN=50 TTL=60 PROTO=TCP SPT={spt} DPT=23"


def some_lines(rng, n):
    out = []
    for _ in range(n):
        hot = rng.random() < 0.4
        src = "192.0.2.1" if hot else f"198.51.{rng.randrange(3)}.{rng.randrange(250)}"
        out.append(LINE.format(d=1 + rng.randrange(4), h=rng.randrange(24), m=rng.randrange(60), s=rng.randrange(60), src=src, spt=rng.randrange(5)))
    return out


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sum"))
    store, summaries = f"{folder}/store", f"{folder}/summaries"
    rng = random.Random(6)
    parts = [some_lines(rng, 500) for _ in range(3)]
    parts[2] += parts[0][:200]
    for k, part in enumerate(parts):
        frame = spark.createDataFrame(list(enumerate(part)), "line_no long, line string")
        for _ in range(2):  # delivered twice
            B.ingest_lines(spark, frame, store, batch=f"b{k}", buckets=2, summaries_path=summaries)
    return store, summaries


def counts_of(spark, store, *columns):
    return {tuple(r[:-1]): r[-1] for r in ST.read_log_store(spark, store).groupBy(*columns).count().collect()}


def check(spark, store, summaries):
    want = sorted(map(tuple, RP.first_last_seen(ST.read_log_store(spark, store)).collect()))
    assert sorted(map(tuple, SM.seen_addresses(spark, store, summaries).collect())) == want
    exact = counts_of(spark, store, "source_ip")
    total = sum(exact.values())
    for one_in in (3, 50, 200):
        got = {r.source_ip: r.events for r in SM.frequent_sources(spark, store, summaries, one_in).collect()}
        assert got == {ip: n for (ip,), n in exact.items() if n * one_in > total} and got


def test_state_after_batches_equals_the_whole(spark, filled):
    check(spark, *filled)
    with pytest.raises(ValueError):
        SM.frequent_sources(spark, *filled, SM.COUNTERS + 1)


@pytest.mark.parametrize("counters", [1, 3, 20])
def test_counters_hold_their_bound(spark, filled, counters):
    store, _ = filled
    rows = ST.batch_rows(spark, store)
    shares = None
    for b in ("b0", "b1", "b2"):
        part = SM.day_counters(rows.where(F.col("batch") == b), counters).withColumn("batch", F.lit(b))
        shares = part if shares is None else shares.unionByName(part)
    merged = SM.merge_counters(shares, counters).collect()
    exact, days = counts_of(spark, store, S.LOG_PARTITION, "source_ip"), counts_of(spark, store, S.LOG_PARTITION)
    named = collections.defaultdict(dict)
    for r in merged:
        assert r.lost * (counters + 1) <= days[(r.log_date,)]
        if r.source_ip is not None:
            named[r.log_date][r.source_ip] = r
            assert r.events <= exact[r.log_date, r.source_ip] <= r.events + r.lost
    assert {r.log_date for r in merged} == {d for d, in days}
    for (day, ip), n in exact.items():
        assert n * (counters + 1) <= days[(day,)] or ip in named[day]
    assert all(len(v) <= counters for v in named.values())


def test_compaction_merges_shares(spark, filled):
    store, summaries = filled
    before = sorted(map(tuple, SM.frequent_by_day(spark, store, summaries).collect()))
    assert ST.compact(spark, store, "whole", summaries) == ["b0", "b1", "b2"]
    assert sorted(map(tuple, SM.frequent_by_day(spark, store, summaries).collect())) == before
    check(spark, store, summaries)


def test_closed_windows_of_a_stream_are_those_of_the_batch(spark, tmp_path):
    src = tmp_path / "src"
    os.makedirs(src)
    lines = sorted(some_lines(random.Random(7), 400))
    geo = spark.createDataFrame([("192.0.2.1", "US", "", "", "", 0.0, 0.0, None), ("198.51.0.1", "", "", "", "", 0.0, 0.0, None)], S.GEO_SCHEMA)
    for k, part in enumerate((lines[:250], lines[200:])):  # in order of time, some lines twice
        (src / f"part-{k}.log").write_text("\n".join(part) + "\n")
        got = run_trend_stream(spark, str(src), str(tmp_path / "out"), geo, width="6 hours", delay="12 hours",
                               checkpoint_location=str(tmp_path / "ckpt"))
        seen = spark.createDataFrame([(i, t) for i, t in enumerate(lines[:250] if k == 0 else lines)], "line_no long, line string")
        store = str(tmp_path / f"store{k}")
        B.ingest_lines(spark, seen, store, buckets=2)
        want = RP.trend_by_window(ST.read_log_store(spark, store), geo, "6 hours", "12 hours")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.select("country").distinct().count() == 2
    every = RP.trend_by_window(ST.read_log_store(spark, store), geo, "6 hours")
    assert every.agg(F.sum("events")).first()[0] == ST.read_log_store(spark, store).count()

"""The bucketed geo table: merges, versions, lookups."""

import datetime as dt
import os

import pytest

from firelog import schemas as S
from firelog.operators import geo as G
from firelog.plans import batch as B
from firelog.plans import reports as RPT
from firelog.sources import geo_store as GS

DAY = dt.datetime(2025, 3, 1)


def rows(spark, ips, city="c", when=DAY):
    return spark.createDataFrame([(ip, "US", "r", city, "isp", 1.0, 2.0, when) for ip in ips], S.GEO_SCHEMA)


def ips(n, start=0):
    return [f"198.18.{i // 200}.{i % 200}" for i in range(start, start + n)]


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_a_merge_rewrites_only_its_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/geo"
    assert GS.read(spark, path).count() == 0 and GS.version(spark, path) == 0
    GS.merge(rows(spark, ips(1000)), path, buckets=32)
    first = files_of(path)
    assert len(first) == 32 and GS.read(spark, path).count() == 1000
    new = ips(6, 2000) + ips(4)
    touched = GS.merge(rows(spark, new, "new"), path)
    assert touched == sorted({GS.bucket_of(ip, 32) for ip in new}) and len(touched) <= 10
    assert len(files_of(path)) == 32 + len(touched) and set(first) < set(files_of(path))
    got = {r.ip_address: r.city for r in GS.read(spark, path).collect()}
    want = dict.fromkeys(ips(1000), "c") | dict.fromkeys(new, "new")
    assert got == want
    # as the merge of the whole table
    whole = G.upsert_geo(rows(spark, ips(1000)), rows(spark, new, "new")).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, GS.read(spark, path).select(*S.GEO_COLUMNS).collect()))
    assert GS.remove_old(spark, path, keep=2) == 0 and GS.remove_old(spark, path) == len(touched)
    assert {r.ip_address: r.city for r in GS.read(spark, path).collect()} == want and len(files_of(path)) == 32
    assert GS.merge(rows(spark, []), path) == [] and GS.version(spark, path) == 2


def test_a_failed_merge_is_not_seen(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/geo"
    GS.merge(rows(spark, ips(50)), path, buckets=8)
    write = GS.write_small
    monkeypatch.setattr(GS, "write_small", lambda s, p, t: (_ for _ in ()).throw(RuntimeError("stopped")) if p.endswith("_current") else write(s, p, t))
    with pytest.raises(RuntimeError):
        GS.merge(rows(spark, ips(5), "lost"), path)
    monkeypatch.setattr(GS, "write_small", write)
    assert {r.city for r in GS.read(spark, path).collect()} == {"c"}
    GS.merge(rows(spark, ips(2), "kept"), path)
    assert sorted(r.city for r in GS.read(spark, path).collect()) == ["c"] * 48 + ["kept"] * 2


def test_a_lookup_opens_one_file(spark, tmp_dir):
    path = f"{tmp_dir}/geo"
    GS.merge(rows(spark, ips(400)), path, buckets=16)
    one = GS.lookup(spark, path, ips(400)[77])
    assert len(one.inputFiles()) == 1 and one.collect()[0].ip == ips(400)[77]
    assert RPT.geo_lookup(spark, path, ips(400)[78]).count() == 1 and GS.lookup(spark, path, "no such").count() == 0
    few = spark.createDataFrame([(ip,) for ip in [*ips(3), "203.0.113.1"]], "ip string")
    many = GS.lookup_many(spark, path, few)
    assert sorted(r.ip for r in many.collect()) == sorted(ips(3))
    assert len(GS.read_of(spark, path, few).inputFiles()) <= 4


def test_enrichment_asks_only_for_new_addresses(spark, tmp_dir):
    path = f"{tmp_dir}/geo"
    flagged = spark.createDataFrame([(ip,) for ip in ips(30) * 2], "source_ip string")
    answers = spark.createDataFrame([(ip, 200, '{"country":"US","city":"A"}') for ip in ips(20)] + [(ips(30)[25], 500, "")],
                                    "ip string, status_code int, body string")
    first = B.run_enrichment_into(spark, flagged, path, answers, "2025-03-01 00:00:00", buckets=4)
    assert (first["geo_candidates"], first["geo_completed"], first["geo_errors"], first["geo_buckets"]) == (30, 20, 10, 4)
    again = B.run_enrichment_into(spark, flagged, path, answers, "2025-03-02 00:00:00")
    assert (again["geo_candidates"], again["geo_completed"], again["geo_buckets"]) == (10, 0, 0)
    assert GS.read(spark, path).count() == 20

"""Provider answer decoding, candidates and the geo table merge."""

import datetime as dt

import pytest

from firelog import schemas as S
from firelog.operators import geo as G

SF = '{"country":"Lusonia","regionName":"North","city":"Porto Alba","isp":"TestNet"}'


def decode(spark, status, body):
    df = spark.createDataFrame([("192.0.2.1", status, body)], "ip string, status_code int, body string")
    return G.decode_answers(df).first().asDict()


def test_decode_without_coordinates(spark):
    r = decode(spark, 200, SF)
    assert r["geo_error"] is None
    assert (r["country"], r["region"], r["city"], r["isp"]) == ("Lusonia", "North", "Porto Alba", "TestNet")
    assert (r["latitude"], r["longitude"]) == (0.0, 0.0)


@pytest.mark.parametrize("status,body,error", [
    (500, SF, "status 500"),
    (404, '{"error":"not found"}', "status 404"),
    (200, '{"country":', "malformed json"),
    (200, '{"country":"X","lat":"north"}', "wrong json type"),
    (200, '{"country":5}', "wrong json type"),
    (200, '["a"]', "wrong json type"),
    (None, None, "no answer"),
])
def test_decode_errors(spark, status, body, error):
    r = decode(spark, status, body)
    assert r["geo_error"] == error
    assert r["country"] is None


@pytest.mark.parametrize("body,expected", [
    ('{"status":"fail","message":"private range"}', ("", "", "", "", 0.0, 0.0)),  # stored empty
    ("null", ("", "", "", "", 0.0, 0.0)),
    ('{"country":null,"city":"OnlyCity","lat":1,"lon":-2.5}', ("", "", "OnlyCity", "", 1.0, -2.5)),
    ('{"country":"A","country":"B"}', ("B", "", "", "", 0.0, 0.0)),   # last duplicate wins
    ('{"country":"A"} trailing', ("A", "", "", "", 0.0, 0.0)),          # first value only
])
def test_decode_empty_fields(spark, body, expected):
    r = decode(spark, 200, body)
    assert r["geo_error"] is None
    assert tuple(r[c] for c in ("country", "region", "city", "isp", "latitude", "longitude")) == expected


def geo_rows(spark, rows):
    return spark.createDataFrame(rows, S.GEO_SCHEMA)


def test_upsert_insert_then_update(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    empty = geo_rows(spark, [])
    first = geo_rows(spark, [("192.0.2.1", "US", "North", "Porto Alba", "TestNet", -8.25, 61.5, t1)])
    after1 = G.upsert_geo(empty, first)
    second = geo_rows(spark, [("192.0.2.1", "US", "North", "Vila Nova", "TestNet", -9.5, 60.0, t2)])
    after2 = G.upsert_geo(after1, second).collect()
    assert len(after2) == 1
    assert after2[0]["city"] == "Vila Nova" and after2[0]["last_updated"] == t2


def test_candidates_and_fetch(spark):
    seen = spark.createDataFrame([("10.0.0.1",), ("10.0.0.2",), ("10.0.0.3",)], "source_ip string")
    geo = geo_rows(spark, [("10.0.0.1", "US", "", "", "", 0.0, 0.0, dt.datetime(2024, 1, 1))])
    cands = G.geo_candidates(seen, geo)
    assert sorted(r.ip for r in cands.collect()) == ["10.0.0.2", "10.0.0.3"]
    answers = spark.createDataFrame([("10.0.0.2", 200, SF)], "ip string, status_code int, body string")
    fetched = {r.ip: r.geo_error for r in G.fetch(cands, answers).collect()}
    assert fetched == {"10.0.0.2": None, "10.0.0.3": "no answer"}
    new = G.as_geo_rows(G.fetch(cands, answers), "2024-02-01 00:00:00")
    merged = {r.ip_address: r.city for r in G.upsert_geo(geo, new).collect()}
    assert merged == {"10.0.0.1": "", "10.0.0.2": "Porto Alba"}


def test_fetch_keeps_the_answers_of_candidates_only(spark):
    cands = spark.createDataFrame([("10.0.0.2",), ("10.0.0.3",)], "ip string")
    answers = spark.createDataFrame([(f"10.1.{i // 256}.{i % 256}", 200, SF) for i in range(500)]
                                    + [("10.0.0.2", 200, SF)], "ip string, status_code int, body string")
    f = G.fetch(cands, answers)
    assert {r.ip: r.geo_error for r in f.collect()} == {"10.0.0.2": None, "10.0.0.3": "no answer"}
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


@pytest.mark.parametrize("body,expected", [
    ('{"Country":"US","REGIONNAME":"North","City":"A","ISP":"x","Lat":1.5,"LON":-2}', ("US", "North", "A", "x", 1.5, -2.0)),
    ('{"country":"exact","COUNTRY":"other"}', ("exact", "", "", "", 0.0, 0.0)),
])
def test_decode_keys_case_insensitive(spark, body, expected):
    r = decode(spark, 200, body)
    assert r["geo_error"] is None
    assert tuple(r[c] for c in ("country", "region", "city", "isp", "latitude", "longitude")) == expected


def test_decode_case_insensitive_wrong_type(spark):
    assert decode(spark, 200, '{"Lat":"north"}')["geo_error"] == "wrong json type"

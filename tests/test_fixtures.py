"""The derived fixtures have the documented shape (FIXTURES.md, sf0.001 row)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from firelog.sources import fixtures as FX

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_counters_match_documented_row(spark):
    c = E.queries()["run_counters"](spark, SF).first().asDict()
    assert (c["lines_read"], c["malformed"], c["benign"], c["flagged"]) == (1100, 177, 354, 569)
    assert (c["errors"], c["inserted"], c["duplicates"]) == (42, 476, 51)
    assert (c["geo_candidates"], c["geo_queued"], c["geo_completed"], c["geo_errors"]) == (28, 0, 12, 16)


def test_hot_source_holds_a_third(spark):
    store = E.queries()["ingest_newest_first"](spark, SF)
    total = store.count()
    hot = store.where(F.col("source_ip") == "10.0.0.1").count()
    assert 0.3 < hot / total < 0.37


def test_answers_cover_every_ipv4_source(spark):
    answers = FX.geo_answers(spark, SF).select("ip")
    seen = E.queries()["seen_source_ips"](spark, SF).where(~F.col("source_ip").contains(":"))
    missing = seen.join(answers, seen.source_ip == answers.ip, "left_anti").count()
    assert missing == 0

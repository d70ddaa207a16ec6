"""Field extraction, validity and flag predicates (unit cases as literal frames)."""

import pytest
from pyspark.sql import functions as F

from firelog.functions.extract import FIELD_ORDER, extract_fields, is_flagged, is_valid
from firelog.operators.triage import parse_lines

FULL = ("2031-11-30T18:45:07.250901-05:00 SRC=203.0.113.77 DST=198.51.100.9 PROTO=TCP SPT=40217 DPT=8443 "
        "action=DROP reason=PORTSCAN LEN=1311 TTL=57")


def fields(spark, line):
    row = spark.createDataFrame([(line,)], "line string").select(*extract_fields(F.col("line"))).first()
    return tuple(row[n] for n in FIELD_ORDER)


@pytest.mark.parametrize("line,expected", [
    ("DPT=25 reason=PORTSCAN action=DROP", True),
    ("reason=MALFORMED-PACKET proto? action=DROP LEN=9", True),
    ("reason=PORTSCAN action=REJECT", False),
    ("reason=PORTSCAN, nothing was done", False),
    ("action=DROP reason=RATE-LIMIT", False),
    # substring semantics: DROPPED counts as DROP, a flag word anywhere counts
    ("action=DROPPED reason=OTHER note=PORTSCAN", True),
    ("action=drop reason=PORTSCAN", False),
])
def test_flag(spark, line, expected):
    got = spark.createDataFrame([(line,)], "line string").select(is_flagged(F.col("line"))).first()[0]
    assert got is expected


def test_extract_full_line(spark):
    assert fields(spark, FULL) == (
        "2031-11-30T18:45:07.250901-05:00", "203.0.113.77", "198.51.100.9", 40217, 8443,
        "TCP", "DROP", "PORTSCAN", 1311, 57)


@pytest.mark.parametrize("line,expected", [
    ("TTL=9 LEN=77 reason=a-b action=PASS DPT=1 SPT=2 PROTO=SCTP DST=10.9.8.7 SRC=10.7.8.9",
     ("unknown", "10.7.8.9", "10.9.8.7", 2, 1, "SCTP", "PASS", "a-b", 77, 9)),
    ("only DPT=631 of all",
     ("unknown", "unknown", "unknown", 0, 631, "unknown", "unknown", "unknown", 0, 0)),
    ("",
     ("unknown", "unknown", "unknown", 0, 0, "unknown", "unknown", "unknown", 0, 0)),
    ("PROTO=IGMP TTL=1 SRC=fd00:7::a1 DST=fd00:7::b2 reason=join",
     ("unknown", "fd00:7::a1", "fd00:7::b2", 0, 0, "IGMP", "unknown", "join", 0, 1)),
    ("DST=-- SRC=fd00:7::a1",
     ("unknown", "fd00:7::a1", "unknown", 0, 0, "unknown", "unknown", "unknown", 0, 0)),
])
def test_extract_edge_cases(spark, line, expected):
    assert fields(spark, line) == expected


@pytest.mark.parametrize("src,expected", [
    ("192.0.2", "192"),              # partial quad: the hex alternative
    ("::ffff:1.2.3.4", "::ffff:1"),
    ("dead.host", "dead"),
    ("2001:db8::15", "2001:db8::15"),
])
def test_ip_alternatives(spark, src, expected):
    assert fields(spark, f"SRC={src} DST=1.2.3.4")[1] == expected


def test_numbers(spark):
    f = fields(spark, "SPT=0080 DPT=99999999999999999999 LEN=99999999999 LEN=5 TTL=")
    assert f[3] == 80          # leading zeros
    assert f[4] == 0           # beyond 64 bits -> 0
    assert f[8] == 99999999999  # first LEN wins; fits 64 bits (rejected later)
    assert f[9] == 0           # TTL= without digits: no match


def test_unanchored_search(spark):
    # XSRC= contains SRC=; first match wins
    assert fields(spark, "XSRC=10.0.0.1 SRC=10.0.0.2 DST=1.1.1.1")[1] == "10.0.0.1"


@pytest.mark.parametrize("line,ok", [
    (FULL, True),
    ("é" + FULL, True),                       # non-ASCII letter is a boundary
    (FULL.replace("2031-11-30T", "x2031-11-30T"), False),  # ASCII letter is not
    (FULL.replace(" SPT=40217", ""), False),
    (FULL.replace(" TTL=57", ""), False),
])
def test_validity(spark, line, ok):
    assert spark.createDataFrame([(line,)], "line string").select(is_valid(F.col("line"))).first()[0] is ok


def test_timestamp_boundary_backtracks(spark):
    # zone followed by a word char: the match drops the zone
    line = FULL.replace("-05:00 ", "-05:00x ")
    assert fields(spark, line)[0] == "2031-11-30T18:45:07.250901"


def test_triage_classes(spark):
    lines = spark.createDataFrame([
        (1, FULL), (2, FULL.replace("action=DROP", "action=ALLOW")), (3, ""), (4, "garbage"),
        (5, FULL.replace(" SPT=40217 DPT=8443", "")),
    ], "line_no long, line string")
    got = {r.line_no: r.line_class for r in parse_lines(lines).collect()}
    assert got == {1: "flagged", 2: "benign", 3: "malformed", 4: "malformed", 5: "malformed"}

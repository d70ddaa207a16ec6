"""Timestamp parsing/formatting and byte sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from firelog.functions.sizes import size_pretty
from firelog.functions.timestamps import normalise_timestamp, timestamp_text


@pytest.mark.parametrize("text,expected", [
    ("2022-11-30T17:08:59.250031-03:30", dt.datetime(2022, 11, 30, 17, 8, 59, 250031)),
    ("2025-01-05T00:01:08Z", dt.datetime(2025, 1, 5, 0, 1, 8)),
    ("2025-01-05T00:01:08+01:00", dt.datetime(2025, 1, 5, 0, 1, 8)),
    ("2025-01-05T00:01:08.1234565", dt.datetime(2025, 1, 5, 0, 1, 8, 123457)),   # rounded
    ("2025-01-05T00:01:08.9999996Z", dt.datetime(2025, 1, 5, 0, 1, 9)),
    ("2025-01-05T24:00:00", dt.datetime(2025, 1, 6, 0, 0, 0)),
    ("2025-12-31T23:59:60", dt.datetime(2026, 1, 1, 0, 0, 0)),
    ("2025-01-05T23:59:60.5-05:00", dt.datetime(2025, 1, 6, 0, 0, 0, 500000)),
    ("2024-13-45T00:00:00-05:00", None),
    ("0000-01-01T00:00:00", None),
    ("2025-01-05T24:00:01", None),
    ("unknown", None),
])
def test_normalise(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(normalise_timestamp(F.col("t"))).first()[0]
    assert got == expected


@pytest.mark.parametrize("ts,expected", [
    (dt.datetime(2025, 1, 5, 0, 1, 8, 100000), "2025-01-05T00:01:08.1Z"),
    (dt.datetime(2025, 1, 5, 0, 1, 8), "2025-01-05T00:01:08Z"),
    (dt.datetime(2025, 1, 5, 0, 1, 8, 143626), "2025-01-05T00:01:08.143626Z"),
])
def test_timestamp_text(spark, ts, expected):
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    assert df.select(timestamp_text(F.col("ts"))).first()[0] == expected


@pytest.mark.parametrize("n,expected", [
    (0, "0 bytes"), (8192, "8192 bytes"), (10239, "10239 bytes"), (10240, "10 kB"),
    (10484736, "10239 kB"), (10485760, "10 MB"), (20971520, "20 MB"),
    (1073741824, "1024 MB"), (10737418240, "10 GB"), (1099511627776 * 20, "20 TB"),
    (1125899906842624 * 30, "30 PB"), (-20971520, "-20 MB"),
])
def test_size_pretty(spark, n, expected):
    assert spark.createDataFrame([(n,)], "n long").select(size_pretty(F.col("n"))).first()[0] == expected

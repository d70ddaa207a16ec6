"""Table schemas, key columns and the fixed values that results depend on.

Everything in the "fixed values" block must stay equal to the behaviour being
reproduced (the syslog field patterns, the flag words, the default texts);
changing any of them changes which lines are flagged or what is extracted.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must not change: they define classification and extraction)
# ---------------------------------------------------------------------------

# Substring that a flagged line must contain (plain, case-sensitive search).
DROP_MARKER = "action=DROP"

# A flagged line must also contain one of these words anywhere in the line.
FLAGGED_REASONS = (
    "POLICY-INPUT-GEN-DISCARD",
    "PORTSCAN",
    "INTRUSION-DETECTED",
    "MALFORMED-PACKET",
)

# Field patterns, written for Java regex. Each is searched (unanchored, first
# match wins). The timestamp pattern is the whole match; the others use group 1.
# The timestamp is delimited by ASCII word-boundary look-arounds instead of
# ``\b`` because Java's ``\b`` treats non-ASCII letters as word characters.
TIMESTAMP_PATTERN = (
    r"(?<![0-9A-Za-z_])"
    r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?([+\-]\d{2}:\d{2}|Z)?"
    r"(?![0-9A-Za-z_])"
)
SRC_PATTERN = r"SRC=(([0-9]{1,3}\.){3}[0-9]{1,3}|([a-fA-F0-9:]+))"
DST_PATTERN = r"DST=(([0-9]{1,3}\.){3}[0-9]{1,3}|([a-fA-F0-9:]+))"
SPT_PATTERN = r"SPT=(\d+)"
DPT_PATTERN = r"DPT=(\d+)"
PROTO_PATTERN = r"PROTO=(\w+)"
ACTION_PATTERN = r"action=(\w+)"
REASON_PATTERN = r"reason=([\w\-]+)"
LEN_PATTERN = r"LEN=(\d+)"
TTL_PATTERN = r"TTL=(\d+)"

# Text written for a missing text field; numbers default to 0.
UNKNOWN = "unknown"

# Default page size and offset of the paged log read.
DEFAULT_PAGE_LIMIT = 50
DEFAULT_PAGE_OFFSET = 0

# Report levels of the per-IP summary (our definition, see README).
LEVEL_HIGH_REASONS = ("INTRUSION-DETECTED",)
LEVEL_MEDIUM_REASONS = ("PORTSCAN", "MALFORMED-PACKET")

# ---------------------------------------------------------------------------
# Schemas and keys
# ---------------------------------------------------------------------------

LINE_CLASSES = ("malformed", "benign", "flagged")

# Unique key of the log store: a new row is inserted only if no stored row
# (and no earlier-processed row of the same batch) has the same key.
LOG_KEY = (
    "timestamp",
    "source_ip",
    "destination_ip",
    "protocol",
    "source_port",
    "destination_port",
)
LOG_PAYLOAD = ("action", "reason", "packet_length", "ttl")
LOG_PARTITION = "log_date"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("source_ip", T.StringType(), False),
        T.StructField("destination_ip", T.StringType(), False),
        T.StructField("protocol", T.StringType(), False),
        T.StructField("source_port", T.IntegerType(), True),
        T.StructField("destination_port", T.IntegerType(), True),
        T.StructField("action", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
        T.StructField("packet_length", T.IntegerType(), True),
        T.StructField("ttl", T.IntegerType(), True),
    ]
)
LOG_COLUMNS = tuple(f.name for f in LOG_SCHEMA.fields)

GEO_SCHEMA = T.StructType(
    [
        T.StructField("ip_address", T.StringType(), False),
        T.StructField("country", T.StringType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("isp", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("last_updated", T.TimestampNTZType(), True),
    ]
)
GEO_COLUMNS = tuple(f.name for f in GEO_SCHEMA.fields)
GEO_ATTRIBUTES = ("country", "region", "city", "isp", "latitude", "longitude")

# Provider answers: one HTTP status and raw JSON body per IP.
GEO_ANSWER_SCHEMA = T.StructType(
    [
        T.StructField("ip", T.StringType(), False),
        T.StructField("status_code", T.IntegerType(), True),
        T.StructField("body", T.StringType(), True),
    ]
)

INT_MIN = -(2**31)
INT_MAX = 2**31 - 1

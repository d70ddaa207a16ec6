"""DuckDB statements that recompute every registered query independently.

DuckDB's regex engine is RE2, so the field patterns appear here in their
original ``\\b`` form, while the Spark side uses look-arounds; agreement of
the two is a real check of the extraction. Building blocks are CTEs that
later statements stack on.
"""

from __future__ import annotations

from firelog.sources.fixtures import (
    GEO_ANSWERS_SQL,
    INTELLIGENCE_SQL,
    LOG_LINES_SQL,
    RUN_AS_OF,
    SECOND_ANSWERS_SQL,
    STALE_AS_OF,
    STALE_CITY,
    duckdb_sql,
)

# Field patterns (RE2) and flag words, as in the source tool.
RE_TS = r"\b\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?([+\-]\d{2}:\d{2}|Z)?\b"
RE_SRC = r"SRC=(([0-9]{1,3}\.){3}[0-9]{1,3}|([a-fA-F0-9:]+))"
RE_DST = r"DST=(([0-9]{1,3}\.){3}[0-9]{1,3}|([a-fA-F0-9:]+))"
RE_SPT = r"SPT=(\d+)"
RE_DPT = r"DPT=(\d+)"
RE_PROTO = r"PROTO=(\w+)"
RE_ACTION = r"action=(\w+)"
RE_REASON = r"reason=([\w\-]+)"
RE_LEN = r"LEN=(\d+)"
RE_TTL = r"TTL=(\d+)"
FLAG_WORDS = ("POLICY-INPUT-GEN-DISCARD", "PORTSCAN", "INTRUSION-DETECTED", "MALFORMED-PACKET")

_RAW = [
    ("timestamp", RE_TS, 0), ("source_ip", RE_SRC, 1), ("destination_ip", RE_DST, 1),
    ("source_port", RE_SPT, 1), ("destination_port", RE_DPT, 1), ("protocol", RE_PROTO, 1),
    ("action", RE_ACTION, 1), ("reason", RE_REASON, 1), ("packet_length", RE_LEN, 1), ("ttl", RE_TTL, 1),
]
NUMS = ("source_port", "destination_port", "packet_length", "ttl")
KEY = "timestamp, source_ip, destination_ip, protocol, source_port, destination_port"
LOG_COLS = KEY + ", action, reason, packet_length, ttl"

_raw_sel = ",\n  ".join(f"regexp_extract(line, '{p}', {g}) AS r_{n}" for n, p, g in _RAW)
_valid = " AND ".join(f"r_{n} <> ''" for n, _, _ in _RAW)
_flag = "contains(line, 'action=DROP') AND (" + " OR ".join(f"contains(line, '{w}')" for w in FLAG_WORDS) + ")"
_typed = ",\n  ".join(
    f"COALESCE(TRY_CAST(r_{n} AS BIGINT), 0) AS {n}" if n in NUMS
    else f"CASE WHEN r_{n} = '' THEN 'unknown' ELSE r_{n} END AS {n}"
    for n, _, _ in _RAW
)
_int_ok = lambda c: f"{c} BETWEEN -2147483648 AND 2147483647"


def lines_cte(batch: str = "") -> str:
    where = f" WHERE {batch}" if batch else ""
    return f"lines AS (SELECT * FROM ({duckdb_sql(LOG_LINES_SQL)}) l{where})"


def parsed_ctes(batch: str = "") -> str:
    """lines -> raw -> parsed(line_no, line, line_class, ten fields)."""
    return f"""{lines_cte(batch)},
raw AS (SELECT line_no, line,
  {_raw_sel}
FROM lines),
parsed AS (SELECT line_no, line,
  CASE WHEN NOT ({_valid}) THEN 'malformed' WHEN {_flag} THEN 'flagged' ELSE 'benign' END AS line_class,
  {_typed}
FROM raw)"""


def rows_ctes(batch: str = "") -> str:
    """... -> rows: flagged lines as typed store rows with reject_reason."""
    reject = (
        "CASE WHEN timestamp IN ('', 'unknown') THEN 'invalid timestamp' "
        "WHEN destination_ip IN ('', 'unknown') THEN 'invalid destination IP' "
        "WHEN ts IS NULL THEN 'timestamp out of range' "
        + " ".join(f"WHEN NOT ({_int_ok(c)}) THEN '{c} out of integer range'" for c in NUMS)
        + " END"
    )
    ints = ", ".join(f"CASE WHEN {_int_ok(c)} THEN CAST({c} AS INTEGER) END AS {c}" for c in NUMS)
    return f"""{parsed_ctes(batch)},
flagged AS (SELECT *, TRY_CAST(regexp_replace(timestamp, '([+\\-]\\d{{2}}:\\d{{2}}|Z)$', '') AS TIMESTAMP) AS ts
            FROM parsed WHERE line_class = 'flagged'),
rows AS (SELECT line_no, line, ts AS timestamp, source_ip, destination_ip, protocol, {ints},
               action, reason, {reject} AS reject_reason, CAST(ts AS DATE) AS log_date
         FROM flagged)"""


def dedup_sql(source: str, order: str) -> str:
    direction = "DESC" if order == "newest" else "ASC"
    return (f"SELECT {LOG_COLS}, log_date FROM {source} "
            f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY line_no {direction}) = 1")


def ingest_ctes(order: str = "newest") -> str:
    """... -> store: all rows after one run over the whole log, empty store."""
    return f"""{rows_ctes()},
store AS ({dedup_sql("(SELECT * FROM rows WHERE reject_reason IS NULL)", order)})"""


def _renamed(ctes: str, suffix: str) -> str:
    """The same CTE chain with every CTE name suffixed (for a second run)."""
    for name in ("lines", "raw", "parsed", "flagged", "rows"):
        ctes = ctes.replace(f"{name} AS (", f"{name}{suffix} AS (")
        ctes = ctes.replace(f"FROM {name})", f"FROM {name}{suffix})").replace(f"FROM {name} ", f"FROM {name}{suffix} ")
    return ctes


def incremental_ctes(order: str = "newest") -> str:
    """Two runs: first half of the log, then the whole log again; store wins."""
    half = _renamed(rows_ctes("line_no < (SELECT count(*) FROM events)"), "1")
    return f"""{half},
store1 AS ({dedup_sql("(SELECT * FROM rows1 WHERE reject_reason IS NULL)", order)}),
{rows_ctes()},
batch2 AS ({dedup_sql("(SELECT * FROM rows WHERE reject_reason IS NULL)", order)}),
store AS (SELECT * FROM store1 UNION ALL
          SELECT * FROM batch2 b WHERE NOT EXISTS (
            SELECT 1 FROM store1 s WHERE s.timestamp = b.timestamp AND s.source_ip = b.source_ip
              AND s.destination_ip = b.destination_ip AND s.protocol = b.protocol
              AND s.source_port = b.source_port AND s.destination_port = b.destination_port))"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["line_class_counts"] = _with(parsed_ctes(), """
SELECT c.line_class, CAST(COALESCE(n.lines, 0) AS BIGINT) AS lines
FROM (VALUES ('malformed'), ('benign'), ('flagged')) c(line_class)
LEFT JOIN (SELECT line_class, count(*) AS lines FROM parsed GROUP BY line_class) n USING (line_class)""")
    q["valid_lines"] = _with(parsed_ctes(), "SELECT line_no, line FROM parsed WHERE line_class <> 'malformed'")
    q["flagged_lines"] = _with(parsed_ctes(), "SELECT line_no, line FROM parsed WHERE line_class = 'flagged'")
    q["extract_all_lines"] = _with(parsed_ctes(), f"SELECT line_no, {', '.join(n for n, _, _ in _RAW)} FROM parsed")
    q["insert_rejects"] = _with(rows_ctes(), "SELECT line_no, line, reject_reason FROM rows WHERE reject_reason IS NOT NULL")
    q["ingest_newest_first"] = _with(ingest_ctes("newest"), "SELECT * FROM store")
    q["ingest_oldest_first"] = _with(ingest_ctes("oldest"), "SELECT * FROM store")
    q["ingest_incremental"] = _with(incremental_ctes("newest"), "SELECT * FROM store")
    return q


# ---------------------------------------------------------------------------
# Geo answers, existing geo table, one enrichment run
# ---------------------------------------------------------------------------

_TEXT_KEYS = {"country": "country", "region": "regionName", "city": "city", "isp": "isp"}
_NUM_KEYS = {"latitude": "lat", "longitude": "lon"}


def _geo_error(body: str = "body", status: str = "status_code") -> str:
    text_bad = " OR ".join(
        f"COALESCE(json_type({body}, '$.{k}'), 'NULL') NOT IN ('NULL', 'VARCHAR')" for k in _TEXT_KEYS.values())
    num_bad = " OR ".join(
        f"COALESCE(json_type({body}, '$.{k}'), 'NULL') NOT IN ('NULL', 'BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT')"
        for k in _NUM_KEYS.values())
    return (f"CASE WHEN {status} IS NULL THEN 'no answer' "
            f"WHEN {status} <> 200 THEN 'status ' || CAST({status} AS VARCHAR) "
            f"WHEN {body} IS NULL THEN 'malformed json' "
            f"WHEN json_type({body}) = 'NULL' THEN NULL "
            f"WHEN json_type({body}) <> 'OBJECT' THEN 'wrong json type' "
            f"WHEN {text_bad} THEN 'wrong json type' "
            f"WHEN {num_bad} THEN 'wrong json type' END")


def _geo_attrs(body: str = "body") -> str:
    parts = []
    for name, k in _TEXT_KEYS.items():
        parts.append(f"CASE WHEN geo_error IS NULL THEN COALESCE(CASE WHEN json_type({body}, '$.{k}') = 'VARCHAR' "
                     f"THEN json_extract_string({body}, '$.{k}') END, '') END AS {name}")
    for name, k in _NUM_KEYS.items():
        parts.append(f"CASE WHEN geo_error IS NULL THEN COALESCE(TRY_CAST(CASE WHEN json_type({body}, '$.{k}') "
                     f"IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') THEN json_extract_string({body}, '$.{k}') END "
                     f"AS DOUBLE), 0.0) END AS {name}")
    return ", ".join(parts)


def geo_ctes() -> str:
    return f"""answers AS ({duckdb_sql(GEO_ANSWERS_SQL)}),
decoded0 AS (SELECT ip, k, status_code, jbody, {_geo_error("jbody")} AS geo_error
             FROM (SELECT *, CASE WHEN json_valid(body) THEN body END AS jbody FROM answers) a),
decoded AS (SELECT ip, k, status_code, {_geo_attrs("jbody")}, geo_error FROM decoded0),
existing AS (SELECT ip AS ip_address, country, region, '{STALE_CITY}' AS city, isp, latitude, longitude,
                    TIMESTAMP '{STALE_AS_OF}' AS last_updated
             FROM decoded WHERE geo_error IS NULL AND k % 5 = 0)"""


def run_ctes() -> str:
    """Ingest (newest first, empty store) + one enrichment run."""
    return f"""{ingest_ctes("newest")},
{geo_ctes()},
seen AS (SELECT DISTINCT source_ip FROM rows),
cands AS (SELECT source_ip AS ip FROM seen s WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.ip_address = s.source_ip)),
fetched AS (SELECT c.ip, d.country, d.region, d.city, d.isp, d.latitude, d.longitude,
                   CASE WHEN d.ip IS NULL THEN 'no answer' ELSE d.geo_error END AS geo_error
            FROM cands c LEFT JOIN decoded d ON d.ip = c.ip),
geo_run AS (SELECT * FROM existing UNION ALL
            SELECT ip AS ip_address, country, region, city, isp, latitude, longitude, TIMESTAMP '{RUN_AS_OF}' AS last_updated
            FROM fetched WHERE geo_error IS NULL)"""


_RUN_METRICS = ("lines_read", "flagged", "benign", "malformed", "inserted", "errors",
                "geo_candidates", "geo_queued", "geo_completed", "geo_errors", "processed", "duplicates")


def _counters_select() -> str:
    return """SELECT
  (SELECT count(*) FROM parsed) AS lines_read,
  (SELECT count(*) FROM parsed WHERE line_class = 'flagged') AS flagged,
  (SELECT count(*) FROM parsed WHERE line_class = 'benign') AS benign,
  (SELECT count(*) FROM parsed WHERE line_class = 'malformed') AS malformed,
  (SELECT count(*) FROM store) AS inserted,
  (SELECT count(*) FROM rows WHERE reject_reason IS NOT NULL) AS errors,
  (SELECT count(*) FROM fetched) AS geo_candidates,
  (SELECT count(*) FROM cands WHERE ip NOT IN (SELECT ip FROM fetched)) AS geo_queued,
  (SELECT count(*) FROM fetched WHERE geo_error IS NULL) AS geo_completed,
  (SELECT count(*) FROM fetched WHERE geo_error IS NOT NULL) AS geo_errors,
  (SELECT count(*) FROM rows) AS processed,
  (SELECT count(*) FROM rows WHERE reject_reason IS NULL) - (SELECT count(*) FROM store) AS duplicates"""


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# Sizes from a few bytes to petabytes, of both signs: an order's key, shifted by 0 to 40 bits.
_HALF = "(a // 512)"
_SIZES = f"""
WITH n AS (SELECT o_orderkey, CAST(o_orderkey AS HUGEINT) * (CAST(1 AS BIGINT) << CAST(o_orderkey % 41 AS INTEGER))
             * CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE 1 END AS size_bytes FROM orders),
s AS (SELECT *, abs(size_bytes) AS a, CASE WHEN size_bytes < 0 THEN '-' ELSE '' END AS sign FROM n)
SELECT o_orderkey, CAST(size_bytes AS BIGINT) AS size_bytes, CASE
  WHEN a < 10240 THEN size_bytes::VARCHAR || ' bytes'
  {" ".join(f"WHEN {_HALF} // {1024 ** i} < 20479 THEN sign || (({_HALF} // {1024 ** i} + 1) // 2)::VARCHAR || ' {u}'"
            for i, u in enumerate(("kB", "MB", "GB", "TB")))}
  ELSE sign || (({_HALF} // {1024 ** 4} + 1) // 2)::VARCHAR || ' PB' END AS size
FROM s"""


def build_more(q: dict[str, str]) -> None:
    geo_cols = "ip_address, country, region, city, isp, latitude, longitude, last_updated"
    q["seen_source_ips"] = _with(run_ctes(), "SELECT source_ip FROM seen")
    q["geo_candidates"] = _with(run_ctes(), "SELECT ip FROM cands")
    q["geo_decode"] = _with(geo_ctes(), "SELECT ip, status_code, country, region, city, isp, latitude, longitude, geo_error FROM decoded")
    q["geo_errors"] = _with(run_ctes(), "SELECT ip, geo_error FROM fetched WHERE geo_error IS NOT NULL")
    q["geo_enrich_run"] = _with(run_ctes(), f"SELECT {geo_cols} FROM geo_run")
    q["geo_upsert"] = _with(geo_ctes() + f""",
new_geo AS (SELECT ip AS ip_address, country, region, city, isp, latitude, longitude, TIMESTAMP '{RUN_AS_OF}' AS last_updated
            FROM decoded WHERE geo_error IS NULL)""", f"""SELECT {geo_cols} FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM new_geo n WHERE n.ip_address = e.ip_address)
UNION ALL SELECT {geo_cols} FROM new_geo""")
    q["enriched_logs"] = _with(run_ctes(), f"""SELECT {", ".join("s." + c.strip() for c in LOG_COLS.split(","))},
  g.country, g.region, g.city, g.isp FROM store s LEFT JOIN geo_run g ON g.ip_address = s.source_ip""")
    ts_text = ("regexp_replace(regexp_replace(strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), '\\.$', '') || 'Z'")
    page = (f"SELECT {ts_text} AS timestamp, source_ip, destination_ip, protocol, action FROM store "
            f"ORDER BY store.timestamp DESC, source_ip, destination_ip, protocol, source_port, destination_port")
    q["logs_page"] = _with(ingest_ctes("newest"), page + " LIMIT 50 OFFSET 0")
    q["logs_page_offset"] = _with(ingest_ctes("newest"), page + " LIMIT 20 OFFSET 100")
    lookup = ("SELECT ip_address AS ip, country, region, city, isp, COALESCE(latitude, 0.0) AS latitude, "
              "COALESCE(longitude, 0.0) AS longitude FROM geo_run WHERE country IS NOT NULL AND region IS NOT NULL "
              "AND city IS NOT NULL AND isp IS NOT NULL")
    q["geo_lookup"] = _with(run_ctes(), lookup + " AND ip_address = '10.0.0.1'")
    q["geo_lookup_bulk"] = _with(run_ctes(), lookup + " AND ip_address IN (SELECT source_ip FROM seen)")
    q["table_row_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS row_count FROM {t}" for t in TABLES)
    q["ingest_rerun_stored"] = q["ingest_incremental"]
    q["stream_growing_file"] = q["ingest_incremental"]
    q["stream_replayed"] = f"SELECT line, reject_reason FROM ({q['insert_rejects']}) t"
    q["logs_page_stored"] = q["logs_page_after"] = q["logs_page_offset"]
    q["geo_merge_stored"], q["geo_lookup_buckets"] = q["geo_enrich_run"], q["geo_lookup_bulk"]
    q["geo_lookup_stored"] = q["geo_lookup_bulk"]
    q["answers_from_json"] = q["geo_decode"]
    q["json_sink_round_trip"] = q["extract_all_lines"]
    q["geo_upsert_duplicates"] = _with(geo_ctes() + f""",
every AS (SELECT ip, k, status_code, body FROM answers UNION ALL SELECT * FROM ({duckdb_sql(SECOND_ANSWERS_SQL)}) t),
one0 AS (SELECT ip, status_code, CASE WHEN json_valid(body) THEN body END AS jbody FROM every
         QUALIFY row_number() OVER (PARTITION BY ip ORDER BY (status_code = 200) DESC, status_code DESC, body DESC) = 1),
one1 AS (SELECT *, {_geo_error("jbody")} AS geo_error FROM one0),
one AS (SELECT ip, {_geo_attrs("jbody")}, geo_error FROM one1),
new_geo AS (SELECT ip AS ip_address, country, region, city, isp, latitude, longitude, TIMESTAMP '{RUN_AS_OF}' AS last_updated
            FROM one WHERE geo_error IS NULL)""", f"""SELECT {geo_cols} FROM existing e
WHERE NOT EXISTS (SELECT 1 FROM new_geo n WHERE n.ip_address = e.ip_address)
UNION ALL SELECT {geo_cols} FROM new_geo""")
    q["size_pretty_values"] = _SIZES
    q["threat_score"] = _with(ingest_ctes("newest") + f""",
feed AS (SELECT ip_address, max(weight) AS weight FROM ({duckdb_sql(INTELLIGENCE_SQL)}) i GROUP BY 1),
per_ip AS (SELECT source_ip, count(*) AS events,
  max(CASE WHEN reason = 'INTRUSION-DETECTED' THEN 2 WHEN reason IN ('PORTSCAN', 'MALFORMED-PACKET') THEN 1 ELSE 0 END) AS lvl
  FROM store GROUP BY 1),
scored AS (SELECT source_ip, events, f.ip_address IS NOT NULL AS listed,
  CAST(least(100, 25 * lvl + least(events, 20) + COALESCE(weight, 0)) AS BIGINT) AS threat_score
  FROM per_ip p LEFT JOIN feed f ON f.ip_address = p.source_ip)""",
        "SELECT source_ip, events, listed, threat_score, threat_score >= 70 AS malicious FROM scored")
    q["run_counters"] = _with(run_ctes(), _counters_select())
    unpivot = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ord, '{m}' AS metric, {m} AS value FROM c" for i, m in enumerate(_RUN_METRICS))
    q["run_summary"] = _with(run_ctes() + ",\nc AS (" + _counters_select() + ")", unpivot)
    q["ip_summary"] = _with(run_ctes() + """,
agg AS (SELECT log_date AS date, source_ip, count(*) AS frequency,
  array_to_string(list_sort(list_distinct(list(destination_port))), ',') AS ports_targeted,
  max(CASE WHEN reason = 'INTRUSION-DETECTED' THEN 2 WHEN reason IN ('PORTSCAN', 'MALFORMED-PACKET') THEN 1 ELSE 0 END) AS lvl,
  array_to_string(list_sort(list_distinct(list(action))), ',') AS action_taken,
  array_to_string(list_sort(list_distinct(list(reason))), ',') AS notes
FROM store GROUP BY 1, 2)""", """SELECT date, a.source_ip, frequency, ports_targeted,
  CASE lvl WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS log_level, action_taken,
  COALESCE(NULLIF(concat_ws(', ', NULLIF(g.city, ''), NULLIF(g.region, ''), NULLIF(g.country, '')), ''), 'unknown') AS geolocation,
  notes
FROM agg a LEFT JOIN geo_run g ON g.ip_address = a.source_ip""")
    q["stream_ingest"] = q["ingest_newest_first"]
    q["first_last_seen"] = _with(ingest_ctes("newest"), "SELECT source_ip, min(timestamp) AS first_seen, max(timestamp) AS last_seen, count(*) AS events FROM store GROUP BY 1")
    q["top_sources"] = _with(ingest_ctes("newest"), "SELECT source_ip, count(*) AS events FROM store GROUP BY 1 ORDER BY events DESC, source_ip LIMIT 10")
    q["top_ports"] = _with(ingest_ctes("newest"), "SELECT destination_port, count(*) AS events FROM store GROUP BY 1 ORDER BY events DESC, destination_port LIMIT 10")
    q["attack_trend"] = _with(run_ctes() + """,
per_ip AS (SELECT log_date, source_ip, count(*) AS n FROM store GROUP BY 1, 2)""", """SELECT p.log_date AS date,
  CASE WHEN COALESCE(g.country, '') = '' THEN 'unknown' ELSE g.country END AS country, CAST(sum(n) AS BIGINT) AS events
FROM per_ip p LEFT JOIN geo_run g ON g.ip_address = p.source_ip GROUP BY 1, 2""")

    q["attack_trend_hourly"] = q["attack_trend_stream"] = _with(run_ctes() + """,
per_ip AS (SELECT date_trunc('hour', timestamp) AS w, source_ip, count(*) AS n FROM store GROUP BY 1, 2)""", """SELECT p.w AS window_start,
  CASE WHEN COALESCE(g.country, '') = '' THEN 'unknown' ELSE g.country END AS country, CAST(sum(n) AS BIGINT) AS events
FROM per_ip p LEFT JOIN geo_run g ON g.ip_address = p.source_ip
WHERE p.w + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(timestamp)) - INTERVAL 1 DAY FROM store) GROUP BY 1, 2""")
    q["seen_state"] = q["first_last_seen"]
    q["frequent_sources"] = _with(ingest_ctes("newest"), "SELECT source_ip, count(*) AS events FROM store GROUP BY 1 HAVING count(*) * 300 > (SELECT count(*) FROM store)")


def build_all() -> dict[str, str]:
    q = build()
    build_more(q)
    return q

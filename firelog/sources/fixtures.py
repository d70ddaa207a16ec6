"""Log lines and geo answers derived from the driver's tables.

The driver's tables hold no syslog text, so syslog lines are generated from
``events`` and provider answers from ``customer`` x ``nation``. The same SQL
text runs in Spark and in DuckDB (the oracle) after two substitutions, so
both engines start from identical input:

``{STR}``  string type name;  ``{TS}``  microsecond timestamp text of ``ts``.
Integer division is written ``CAST(floor(x / n) AS BIGINT)``, valid in both.

Every line exercises one rule: empty line (k%29), missing timestamp (k%17),
port-less ICMP (k%13) -> malformed; ALLOW / RATE-LIMIT -> benign; impossible
date (k%31) and port beyond INTEGER (k%37) -> rejected; 20-digit port (k%41)
-> 0; IPv6 source (k%11). Every tenth event is logged twice with equal wall
clock, another offset and TTL+1, so the survivor depends on read order. One
source address sends a third of all lines (k%3=1), the skewed case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _ipv4(n: str) -> str:
    return (
        "concat(CAST(10 + CAST(floor({n} / 16777216) AS BIGINT) % 246 AS {{STR}}), '.', CAST(CAST(floor({n} / 65536) AS BIGINT) % 256 AS {{STR}}), '.', "
        "CAST(CAST(floor({n} / 256) AS BIGINT) % 256 AS {{STR}}), '.', CAST({n} % 256 AS {{STR}}))"
    ).format(n=n)


LOG_LINES_SQL = """
WITH src AS (
  SELECT event_id AS k, 2 * event_id AS line_no, 0 AS dup, ts, user_id, event_type FROM {events}
  UNION ALL
  SELECT event_id AS k, 2 * event_id + 1 AS line_no, 1 AS dup, ts, user_id, event_type FROM {events} WHERE event_id % 10 = 0
)
SELECT line_no, CASE WHEN k % 29 = 0 THEN '' ELSE concat(
  CASE WHEN k % 17 = 0 THEN 'Mar 14 07:25:40' WHEN k % 31 = 0 THEN '2024-13-45T00:00:00-05:00'
       ELSE concat({TS}, CASE WHEN dup = 1 THEN '+01:00' ELSE '-05:00' END) END,
  ' gate1 pf[412]: action=', CASE WHEN event_type = 'view' THEN 'ALLOW' ELSE 'DROP' END,
  ' reason=', CASE event_type WHEN 'error' THEN 'PORTSCAN' WHEN 'click' THEN 'POLICY-INPUT-GEN-DISCARD'
       WHEN 'view' THEN 'WHITELIST' WHEN 'signup' THEN 'RATE-LIMIT'
       ELSE CASE WHEN k % 2 = 0 THEN 'INTRUSION-DETECTED' ELSE 'MALFORMED-PACKET' END END,
  ' SRC=', CASE WHEN k % 11 = 0 THEN concat('2001:db8::', CAST(user_id AS {STR}))
                ELSE IPV4_OF_U END,
  ' DST=198.51.100.', CAST(k % 20 AS {STR}),
  ' LEN=', CAST(40 + k % 1400 AS {STR}), ' TTL=', CAST(32 + k % 200 + dup AS {STR}),
  CASE WHEN k % 13 = 0 THEN ' PROTO=ICMP' ELSE concat(
    ' PROTO=', CASE WHEN k % 3 = 0 THEN 'UDP' ELSE 'TCP' END,
    ' SPT=', CASE WHEN k % 37 = 0 THEN '99999999999' WHEN k % 41 = 0 THEN '99999999999999999999'
                  ELSE CAST(1024 + (k * 7) % 60000 AS {STR}) END,
    ' DPT=', CASE k % 6 WHEN 0 THEN '22' WHEN 1 THEN '80' WHEN 2 THEN '443' WHEN 3 THEN '3389'
                  WHEN 4 THEN '23' ELSE '5060' END) END
) END AS line
FROM (SELECT *, CASE WHEN k % 3 = 1 THEN 1 ELSE user_id END AS u FROM src) s
""".replace("IPV4_OF_U", _ipv4("u"))

GEO_ANSWERS_SQL = """
SELECT ip, k, CASE WHEN k % 19 = 0 THEN 500 ELSE 200 END AS status_code,
 CASE WHEN k % 23 = 0 THEN '{"country":' WHEN k % 7 = 0 THEN '{"status":"fail","message":"private range"}'
  WHEN k % 29 = 0 THEN '{"country":"X","lat":"north"}' WHEN k % 31 = 0 THEN 'null'
  WHEN k % 37 = 0 THEN '{"country":null,"city":"OnlyCity"}'
  ELSE concat('{"country":"', n_name, '","regionName":"', c_mktsegment, '","city":"City',
              CAST(k % 50 AS {STR}), '","isp":"', c_name, '","lat":', CAST(k % 90 AS {STR}),
              '.5,"lon":-', CAST(k % 180 AS {STR}), '}') END AS body
FROM (SELECT c_custkey AS k, IPV4_OF_K AS ip, c_mktsegment, c_name, n_name
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey) c
""".replace("IPV4_OF_K", _ipv4("c_custkey"))

# A second answer of every third customer, as a provider that was asked twice sends it.
SECOND_ANSWERS_SQL = """
SELECT ip, k, 200 AS status_code, concat('{"country":"Again","city":"Second', CAST(k % 50 AS {STR}), '"}') AS body
FROM {answers} a WHERE k % 3 = 0
"""

# A feed of suspect addresses: every second supplier, some listed twice.
INTELLIGENCE_SQL = """
SELECT IPV4_OF_S AS ip_address, 10 + s_suppkey % 50 AS weight FROM {supplier} WHERE s_suppkey % 2 = 1
UNION ALL
SELECT IPV4_OF_S AS ip_address, 30 AS weight FROM {supplier} WHERE s_suppkey % 6 = 1
""".replace("IPV4_OF_S", _ipv4("s_suppkey"))

# Existing geo rows (before enrichment): decodable answers of every fifth
# customer, marked stale.
STALE_CITY = "stale"
STALE_AS_OF = "2024-01-01 00:00:00"
RUN_AS_OF = "2024-02-01 00:00:00"

SPARK_SUBST = {
    "{STR}": "STRING",
    "{TS}": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
}
DUCKDB_SUBST = {
    "{STR}": "VARCHAR",
    "{TS}": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
}


def render(sql: str, subst: dict[str, str], tables: dict[str, str] | None = None) -> str:
    for k, v in subst.items():
        sql = sql.replace(k, v)
    for name, ref in (tables or {}).items():
        sql = sql.replace("{" + name + "}", ref)
    return sql


def duckdb_sql(sql: str) -> str:
    """Fixture SQL for DuckDB, reading the pre-registered views."""
    return render(sql, DUCKDB_SUBST, {"events": "events", "customer": "customer", "nation": "nation", "supplier": "supplier",
                                      "answers": "answers"})


def spark_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run fixture SQL in Spark with DataFrames bound to ``{name}`` slots."""
    text = render(sql, SPARK_SUBST).replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace("{{" + name + "}}", "{" + name + "}")
    return spark.sql(text, **tables)


# Columns the fixtures read (an explicit schema avoids a footer-reading job
# per read and prunes the scan to these columns).
SOURCE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "supplier": "s_suppkey BIGINT",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dealt(table: DataFrame, key: str) -> DataFrame:
    """A table that may be one row group, dealt out to as many tasks as a shuffle has."""
    return table.repartition(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_no BIGINT, line STRING)``: one syslog line per event (+ copies)."""
    from firelog.operators.fence import fence

    events = _dealt(read_table(spark, sf_dir, "events"), "event_id")
    # Fenced: the generated line is a column like a scanned one, so later
    # filters test it instead of re-building it.
    return fence(spark_sql(spark, LOG_LINES_SQL, events=events))


def geo_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ip, k, status_code, body)``: one provider answer per customer."""
    customer = _dealt(read_table(spark, sf_dir, "customer"), "c_custkey")
    nation = read_table(spark, sf_dir, "nation")
    return spark_sql(spark, GEO_ANSWERS_SQL, customer=customer, nation=nation)


def repeated_answers(spark: SparkSession, answers: DataFrame) -> DataFrame:
    """``answers`` with a second answer of every third customer."""
    return answers.unionByName(spark_sql(spark, SECOND_ANSWERS_SQL, answers=answers))


def intelligence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ip_address, weight)``: a feed of suspect addresses; some are listed twice."""
    return spark_sql(spark, INTELLIGENCE_SQL, supplier=read_table(spark, sf_dir, "supplier"))


def first_batch(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """First half of the log by position (events with id below n/2)."""
    from pyspark.sql import functions as F

    n = read_table(spark, sf_dir, "events").select(F.count("*")).scalar()
    return lines.where(F.col("line_no") < n)


# Lines of one log file of ``grow``.
FILE_LINES = 50_000


def grow(lines: DataFrame, folder: str) -> int:
    """``lines`` as log files of ``FILE_LINES`` lines each, every file written whole; the number of lines.

    Called with more lines of the same log, the last file becomes longer and
    files are added, as a log grows.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F

    from firelog.sources.growing import open_fs

    def write(key, table):
        fs, inner = open_fs(folder)
        fs.create_dir(inner, recursive=True)
        text = table.sort_by("line_no").column("line").to_pylist()
        with fs.open_output_stream(f"{inner}/firewall-{key[0].as_py():09d}.log") as out:
            out.write("".join(f"{t}\n" for t in text).encode())
        return pa.table({"n": pa.array([len(text)], pa.int64())})

    numbered = lines.select("line_no", "line", F.floor(F.col("line_no") / FILE_LINES).cast("long").alias("file"))
    return numbered.groupBy("file").applyInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0

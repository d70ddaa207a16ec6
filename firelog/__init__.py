"""firelog: firewall-log threat analytics on Spark.

Syslog text in; classified, deduplicated and geo-enriched Parquet tables
out; reports over them. Every public function maps DataFrames to
DataFrames using built-in Spark expressions.

Main entry points::

    from firelog import read_log_lines, parse_lines, ingest, enrich
    from firelog.plans.batch import run, run_ingest          # jobs that write
    from firelog.plans.reports import ip_summary_report      # reads of stored tables
    from firelog.streaming.ingest_stream import start_ingest_stream
"""

__version__ = "0.1.0"

from firelog.operators.geo import enrich  # noqa: E402
from firelog.operators.ingest import ingest, insert_if_absent  # noqa: E402
from firelog.operators.reads import geo_lookup, logs_page  # noqa: E402
from firelog.operators.report import ip_summary, run_summary  # noqa: E402
from firelog.operators.triage import parse_lines  # noqa: E402
from firelog.sources.lines import read_log_lines  # noqa: E402

__all__ = [
    "read_log_lines", "parse_lines", "ingest", "insert_if_absent", "enrich",
    "logs_page", "geo_lookup", "ip_summary", "run_summary",
]

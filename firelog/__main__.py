"""Command line: ``python -m firelog <command> ...`` (or via spark-submit).

    ingest   --logs PATH... --store PATH [--oldest-first] [--rejects PATH]
             [--answers PATH --geo-in PATH --geo-out PATH --as-of TS]
    stream   --source DIR --store PATH [--checkpoint PATH]
    page     --store PATH [--limit N] [--offset N]
    lookup   --geo PATH --ip ADDRESS
    stats    --table NAME=PATH ...
    summary  --store PATH --geo PATH [--from DAY] [--to DAY] [--out PATH]

Results are printed as JSON lines (small outputs) or written with ``--out``.
The session is taken from the environment (spark-submit); ``--local N`` starts
a local one for trying things out.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    if args.local:
        from firelog.session import local_session

        return local_session(cores=args.local)
    from firelog.session import configure

    return configure(SparkSession.builder.appName("firelog").getOrCreate())


def _print_rows(df, limit: int | None = None) -> None:
    rows = df.limit(limit).collect() if limit else df.collect()
    for r in rows:
        print(json.dumps(r.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="firelog")
    ap.add_argument("--local", type=int, default=0, help="run a local session with N cores")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest")
    p.add_argument("--logs", nargs="+", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--oldest-first", action="store_true")
    p.add_argument("--rejects")
    p.add_argument("--answers")
    p.add_argument("--answers-format", default="parquet")
    p.add_argument("--geo-in")
    p.add_argument("--geo-out")
    p.add_argument("--as-of")
    p.add_argument("--flagged-only", action="store_true",
                   help="parse only lines that pass the flag test (benign/malformed not counted)")
    p.add_argument("--fail-on-long-lines", action="store_true",
                   help="stop the run at a line over 64 KiB")

    p = sub.add_parser("stream")
    p.add_argument("--source", required=True)
    p.add_argument("--store", required=True)
    p.add_argument("--checkpoint")
    p.add_argument("--rejects")
    p.add_argument("--oldest-first", action="store_true")
    p.add_argument("--flagged-only", action="store_true")
    p.add_argument("--follow", action="store_true", help="files grow: read the bytes added since the last batch")
    p.add_argument("--every", help="do not stop: one micro-batch per interval, such as '30 seconds'")

    p = sub.add_parser("page")
    p.add_argument("--store", required=True)
    p.add_argument("--limit")
    p.add_argument("--offset")

    p = sub.add_parser("lookup")
    p.add_argument("--geo", required=True)
    p.add_argument("--ip", required=True)

    p = sub.add_parser("stats")
    p.add_argument("--table", nargs="+", required=True, help="NAME=PATH")

    p = sub.add_parser("summary")
    p.add_argument("--store", required=True)
    p.add_argument("--geo", required=True)
    p.add_argument("--from", dest="first_day")
    p.add_argument("--to", dest="last_day")
    p.add_argument("--out")

    args = ap.parse_args(argv)
    spark = _session(args)
    order = "oldest" if getattr(args, "oldest_first", False) else "newest"

    if args.cmd == "ingest":
        from firelog.plans import batch as B
        from firelog.sources.tables import read_geo_answers

        if args.answers:
            if not (args.geo_out and args.as_of):
                ap.error("--answers needs --geo-out and --as-of")
            answers = read_geo_answers(spark, args.answers, args.answers_format)
            counts = B.run(spark, args.logs, args.store, answers, args.geo_in, args.geo_out, args.as_of,
                           order, args.rejects, classify_all=not args.flagged_only,
                           long_lines="fail" if args.fail_on_long_lines else "keep")
        else:
            counts = B.run_ingest(spark, args.logs, args.store, order, args.rejects,
                                  classify_all=not args.flagged_only,
                                  long_lines="fail" if args.fail_on_long_lines else "keep")
        _print_rows(B.summary_frame(spark, counts))
    elif args.cmd == "stream":
        from firelog.streaming.ingest_stream import run_ingest_stream, start_ingest_stream

        kw = dict(checkpoint_location=args.checkpoint, order=order, rejects_path=args.rejects,
                  classify_all=not args.flagged_only, follow=args.follow)
        if args.every:
            start_ingest_stream(spark, args.source, args.store, available_now=False, processing_time=args.every, **kw).awaitTermination()
        else:
            for c in run_ingest_stream(spark, args.source, args.store, **kw):
                print(json.dumps(c, default=str))
    elif args.cmd == "page":
        from firelog.plans.reports import logs_page

        _print_rows(logs_page(spark, args.store, args.limit, args.offset))
    elif args.cmd == "lookup":
        from firelog.plans.reports import geo_lookup

        rows = geo_lookup(spark, args.geo, args.ip).collect()
        print(json.dumps(rows[0].asDict() if rows else {"error": "IP not found"}))
        return 0 if rows else 1
    elif args.cmd == "stats":
        from firelog.operators.stats import database_size, table_stats

        tables = dict(t.split("=", 1) for t in args.table)
        stats = table_stats(spark, tables)
        _print_rows(stats)
        _print_rows(database_size(stats))
    elif args.cmd == "summary":
        from firelog.plans.reports import ip_summary_report

        rep = ip_summary_report(spark, args.store, args.geo, args.first_day, args.last_day)
        if args.out:
            rep.write.mode("errorifexists").parquet(args.out)
        else:
            for r in rep.orderBy("date", "source_ip").toLocalIterator():
                print(json.dumps(r.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

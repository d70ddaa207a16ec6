"""

Every query reads the driver's parquet tables under ``sf_dir`` (syslog lines
are derived from ``events``, provider answers from ``customer`` x
``nation``; see ``firelog.sources.fixtures``) and runs the library's
operators over the whole of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.functions.extract import FIELD_ORDER
from firelog.functions.sizes import size_pretty
from firelog.operators import geo as G
from firelog.operators import ingest as I
from firelog.operators import reads as R
from firelog.operators import report as RP
from firelog.operators import stats as ST
from firelog.operators import threat as TH
from firelog.operators import triage as TR
from firelog.plans import batch as PB
from firelog.plans import reports as PR
from firelog.session import configure, scratch_path
from firelog.sources import fixtures as FX
from firelog.sources import geo_store as GS
from firelog.sources import store as SR
from firelog.sources import summaries as SM
from firelog.sources import tables as TB
from firelog.sources.files import delete, names
from firelog.streaming import trend_stream as TS
from firelog.streaming.ingest_stream import run_ingest_stream

SMOKE_DIR = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return FX.log_lines(spark, sf_dir)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_line_class_counts(spark, sf_dir):
    return TR.class_counts(_lines(spark, sf_dir))


def q_valid_lines(spark, sf_dir):
    c = TR.classify(_lines(spark, sf_dir))
    return c.where(F.col("line_class") != "malformed").select("line_no", "line")


def q_flagged_lines(spark, sf_dir):
    c = TR.classify(_lines(spark, sf_dir))
    return c.where(F.col("line_class") == "flagged").select("line_no", "line")


def q_extract_all_lines(spark, sf_dir):
    return TR.parse_lines(_lines(spark, sf_dir)).select("line_no", *FIELD_ORDER)


def q_insert_rejects(spark, sf_dir):
    out = I.ingest(_lines(spark, sf_dir))
    return out["rejected"].select("line_no", "line", "reject_reason")


def _store_cols(df: DataFrame) -> DataFrame:
    return df.select(*S.LOG_COLUMNS, S.LOG_PARTITION)


def q_ingest_newest_first(spark, sf_dir):
    return _store_cols(I.ingest(_lines(spark, sf_dir), order="newest")["new_rows"])


def q_ingest_oldest_first(spark, sf_dir):
    return _store_cols(I.ingest(_lines(spark, sf_dir), order="oldest")["new_rows"])


def q_ingest_incremental(spark, sf_dir):
    """Two runs: the first half of the log, then the whole log again (store wins).

    Store rows depend only on their own line, so the whole log is parsed once
    (written to scratch) and run 1 takes its rows by line position.
    """
    lines = _lines(spark, sf_dir)
    rows = _stored(I.store_rows_from_lines(lines), "rows")
    acc = I.accepted(rows)
    first = I.insert_if_absent(FX.first_batch(spark, sf_dir, acc), None)
    second = I.insert_if_absent(acc, store=first)
    return _store_cols(first).unionByName(_store_cols(second))


def _store(spark, sf_dir, order="newest"):
    return _store_cols(I.ingest(_lines(spark, sf_dir), order=order)["new_rows"])


def _existing_geo(spark, sf_dir):
    """Geo table before the run: decodable answers of every fifth customer, stale."""
    dec = G.decode_answers(FX.geo_answers(spark, sf_dir))
    ok = dec.where(F.col("geo_error").isNull() & (F.col("k") % 5 == 0))
    return ok.select(
        F.col("ip").alias("ip_address"), "country", "region", F.lit(FX.STALE_CITY).alias("city"), "isp",
        "latitude", "longitude", F.lit(FX.STALE_AS_OF).cast("timestamp_ntz").alias("last_updated"),
    )


def _enriched(spark, sf_dir, rows=None):
    """One enrichment run; of the flagged rows (or the log) only the distinct source addresses are written to scratch."""
    rows = I.store_rows_from_lines(_lines(spark, sf_dir)) if rows is None else rows
    seen = _stored(G.seen_source_ips(rows), "seen")
    return G.enrich(seen, _existing_geo(spark, sf_dir), FX.geo_answers(spark, sf_dir), FX.RUN_AS_OF)


def _run(spark, sf_dir):
    """Ingest of the whole log (newest first) + one enrichment run.

    The flagged rows feed both; they are written to the shared scratch folder
    once, as the batch job in ``firelog.plans.batch`` does, so the regex pass
    runs once.
    """
    rows = _stored(I.store_rows_from_lines(_lines(spark, sf_dir)), "rows")
    return {"rows": rows, "new_rows": I.insert_if_absent(I.accepted(rows), None, "newest")}, _enriched(spark, sf_dir, rows)


def q_seen_source_ips(spark, sf_dir):
    return _enriched(spark, sf_dir)["seen"]


def q_geo_candidates(spark, sf_dir):
    return _enriched(spark, sf_dir)["candidates"]


def q_geo_decode(spark, sf_dir):
    dec = G.decode_answers(FX.geo_answers(spark, sf_dir))
    return dec.select("ip", "status_code", *G.DECODED_COLUMNS)


def q_geo_errors(spark, sf_dir):
    f = _enriched(spark, sf_dir)["fetched"]
    return f.where(F.col("geo_error").isNotNull()).select("ip", "geo_error")


def q_geo_enrich_run(spark, sf_dir):
    return _enriched(spark, sf_dir)["geo"].select(*S.GEO_COLUMNS)


def q_geo_upsert(spark, sf_dir):
    fetched = G.decode_answers(FX.geo_answers(spark, sf_dir))
    new_rows = G.as_geo_rows(fetched, FX.RUN_AS_OF)
    return G.upsert_geo(_existing_geo(spark, sf_dir), new_rows)


def _store_and_geo(spark, sf_dir):
    out, geo = _run(spark, sf_dir)
    return _store_cols(out["new_rows"]), geo["geo"]


def q_enriched_logs(spark, sf_dir):
    return RP.enriched_logs(*_store_and_geo(spark, sf_dir))


def q_logs_page(spark, sf_dir):
    return R.logs_page(_store(spark, sf_dir))


def q_logs_page_offset(spark, sf_dir):
    return R.logs_page(_store(spark, sf_dir), limit=20, offset=100)


def q_geo_lookup(spark, sf_dir):
    return R.geo_lookup(_enriched(spark, sf_dir)["geo"], "10.0.0.1")


def q_geo_lookup_bulk(spark, sf_dir):
    geo = _enriched(spark, sf_dir)
    return R.geo_lookup_many(geo["geo"], geo["seen"], "source_ip")


def _source_tables(sf_dir):
    return {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES}


def q_table_stats(spark, sf_dir):
    return ST.table_stats(spark, _source_tables(sf_dir))


def q_database_size(spark, sf_dir):
    return ST.database_size(ST.table_stats(spark, _source_tables(sf_dir)))


def q_table_row_counts(spark, sf_dir):
    return ST.table_stats(spark, _source_tables(sf_dir)).select("name", "row_count")


def _summary(spark, sf_dir):
    """Lines are counted by class while their flagged rows are written; no other copy of them is."""
    cls, seen = F.col("line_class"), Observation("run_summary_lines")
    parsed = TR.parse_lines(_lines(spark, sf_dir)).observe(
        seen, F.count(F.lit(1)).alias("lines_read"), *(F.count_if(cls == c).alias(c) for c in S.LINE_CLASSES))
    rows = _stored(I.store_rows_from_parsed(parsed), "rows")
    new_rows = I.insert_if_absent(I.accepted(rows), None, "newest")
    return RP.run_summary(seen.get, rows, new_rows, _enriched(spark, sf_dir, rows)["fetched"])


def q_run_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_run_counters(spark, sf_dir):
    return RP.run_counters_from(_summary(spark, sf_dir))


def q_ip_summary(spark, sf_dir):
    return RP.ip_summary(*_store_and_geo(spark, sf_dir))


def q_first_last_seen(spark, sf_dir):
    return RP.first_last_seen(_store(spark, sf_dir))


def q_top_sources(spark, sf_dir):
    return RP.top_sources(_store(spark, sf_dir))


def q_top_ports(spark, sf_dir):
    return RP.top_ports(_store(spark, sf_dir))


def q_attack_trend(spark, sf_dir):
    return RP.attack_trend(*_store_and_geo(spark, sf_dir))


def q_attack_trend_hourly(spark, sf_dir):
    """Flagged rows per hour and country, of the hours a day or more before the last time in the log."""
    return RP.trend_by_window(*_store_and_geo(spark, sf_dir), "1 hour", TS.DELAY)


def q_attack_trend_stream(spark, sf_dir):
    """The same from the log as a stream: event-time windows that the watermark has closed."""
    lines = _lines(spark, sf_dir)
    geo = _stored(_enriched(spark, sf_dir)["geo"], "trend-geo")
    return TS.run_trend_stream(spark, _text(lines, "trend-src"), scratch_path(spark, "trend-out"), geo)


def _summarised(spark, sf_dir):
    """A store with summaries, filled in two batches of which the second repeats the first; their paths."""
    lines, store, summaries = _lines(spark, sf_dir), scratch_path(spark, "sum-store"), scratch_path(spark, "summaries")
    for part in (FX.first_batch(spark, sf_dir, lines), lines):
        PB.ingest_lines(spark, part, store, classify_all=False, summaries_path=summaries)
    return store, summaries


def q_seen_state(spark, sf_dir):
    """First and last time of every address, kept up to date batch by batch."""
    return SM.seen_addresses(spark, *_summarised(spark, sf_dir))


def q_frequent_sources(spark, sf_dir):
    """Addresses with more than one in 300 of all stored rows, found by the days' summaries."""
    return SM.frequent_sources(spark, *_summarised(spark, sf_dir), 300)


def q_stream_ingest(spark, sf_dir):
    """Fixture log written as text files, ingested by the file stream."""
    src = scratch_path(spark, "stream-src")
    _lines(spark, sf_dir).orderBy("line_no").select("line").write.text(src)
    store = scratch_path(spark, "stream-store")
    run_ingest_stream(spark, src, store)
    return _store_cols(TB.read_log_store(spark, store))


def _text(lines: DataFrame, name: str) -> str:
    """The lines written as text files in line order; their folder."""
    path = scratch_path(lines.sparkSession, name)
    lines.orderBy("line_no").select("line").write.text(path)
    return path


def q_ingest_rerun_stored(spark, sf_dir):
    """First half of the log read from text into a store, then the whole log into the same store."""
    lines, store = _lines(spark, sf_dir), scratch_path(spark, "rerun-store")
    PB.run_ingest(spark, _text(FX.first_batch(spark, sf_dir, lines), "rerun-first"), store)
    PB.run_ingest(spark, _text(lines, "rerun-all"), store)
    return _store_cols(TB.read_log_store(spark, store))


def q_stream_replayed(spark, sf_dir):
    """Rejected lines after a stream whose last micro-batch was delivered twice: those of one run.

    The log arrives as several files, one per micro-batch. The commit entry of
    the last batch is removed from the checkpoint, as after a crash before it
    was written, and the stream is started again.
    """
    folder = scratch_path(spark, "replay")
    src, store, rejects, ckpt = (f"{folder}/{part}" for part in ("src", "store", "rejects", "ckpt"))
    _lines(spark, sf_dir).repartitionByRange(3, "line_no").sortWithinPartitions("line_no").select("line").write.text(src)
    for _ in range(2):
        run_ingest_stream(spark, src, store, checkpoint_location=ckpt, rejects_path=rejects, max_files_per_trigger=1)
        delete(spark, f"{ckpt}/commits/{[n for n in names(spark, f'{ckpt}/commits') if n.isdigit()][-1]}")
    return SR.rejects(spark, rejects, store).select("line", "reject_reason")


def q_stream_growing_file(spark, sf_dir):
    """A log file that holds its first half at one run and all of it at the next; each run reads what is new."""
    lines = _lines(spark, sf_dir)
    folder = scratch_path(spark, "growing")
    src, store, ckpt = (f"{folder}/{part}" for part in ("src", "store", "ckpt"))
    for half in (FX.first_batch(spark, sf_dir, lines), lines):
        FX.grow(half, src)
        run_ingest_stream(spark, src, store, checkpoint_location=ckpt, follow=True)
    return _store_cols(TB.read_log_store(spark, store))


def q_logs_page_stored(spark, sf_dir):
    """A page of a stored log, found through the store's day index."""
    return PR.logs_page(spark, _page_store(spark, sf_dir), limit=20, offset=100)


def _page_store(spark, sf_dir):
    store = scratch_path(spark, "page-store")
    PB.ingest_lines(spark, _lines(spark, sf_dir), store)
    return store


def q_logs_page_after(spark, sf_dir):
    """The page after the hundredth row of a stored log, by its key."""
    store = _page_store(spark, sf_dir)
    first = PR.logs_page_after(spark, store, None, 100).collect()  # one page
    return R.page_text(PR.logs_page_after(spark, store, R.page_key(first[-1]) if len(first) == 100 else None, 20 if len(first) == 100 else 1))


def _merged_geo(spark, sf_dir):
    """A bucketed geo table after an enrichment run over the log's flagged addresses; its path and the addresses."""
    seen = _stored(G.seen_source_ips(I.store_rows_from_lines(_lines(spark, sf_dir))), "seen")
    path = scratch_path(spark, "geo-buckets")
    GS.merge(_existing_geo(spark, sf_dir), path, buckets=16)
    PB.run_enrichment_into(spark, seen, path, FX.geo_answers(spark, sf_dir), FX.RUN_AS_OF)
    return path, seen


def q_geo_merge_stored(spark, sf_dir):
    """The bucketed geo table after a merge that rewrites only the buckets it touches."""
    return GS.read(spark, _merged_geo(spark, sf_dir)[0]).select(*S.GEO_COLUMNS)


def q_geo_lookup_buckets(spark, sf_dir):
    """Every seen address looked up in the bucketed geo table."""
    path, seen = _merged_geo(spark, sf_dir)
    return GS.lookup_many(spark, path, seen, "source_ip")


def q_geo_lookup_stored(spark, sf_dir):
    """An enrichment run writes the geo table; every seen address is looked up in it."""
    rows = _stored(G.seen_source_ips(I.store_rows_from_lines(_lines(spark, sf_dir))), "rows")
    before, after = scratch_path(spark, "geo-before"), scratch_path(spark, "geo-after")
    TB.write_geo_table(_existing_geo(spark, sf_dir), before)
    PB.run_enrichment(spark, rows, before, FX.geo_answers(spark, sf_dir), after, FX.RUN_AS_OF)
    return R.geo_lookup_many(TB.read_geo_table(spark, after), G.seen_source_ips(rows), "source_ip")


def q_answers_from_json(spark, sf_dir):
    """Answers written as JSON lines, read back as a provider's export and decoded."""
    path = scratch_path(spark, "answers-json")
    TB.write_json(FX.geo_answers(spark, sf_dir).select("ip", "status_code", "body"), path)
    return G.decode_answers(TB.read_geo_answers(spark, path, "json")).select("ip", "status_code", *G.DECODED_COLUMNS)


def q_json_sink_round_trip(spark, sf_dir):
    """Extracted fields of every line through the JSON sink."""
    fields, path = q_extract_all_lines(spark, sf_dir), scratch_path(spark, "fields-json")
    TB.write_json(fields, path)
    return spark.read.schema(fields.schema).json(path)


def q_geo_upsert_duplicates(spark, sf_dir):
    """Several answers for one address: one geo row, the documented winner."""
    every = FX.repeated_answers(spark, FX.geo_answers(spark, sf_dir))
    fetched = G.fetch(every.select("ip").distinct(), every)
    return G.upsert_geo(_existing_geo(spark, sf_dir), G.as_geo_rows(fetched, FX.RUN_AS_OF))


def q_size_pretty_values(spark, sf_dir):
    """Readable sizes of numbers from bytes to petabytes, of both signs."""
    orders = FX.read_table(spark, sf_dir, "orders").select("o_orderkey")
    shifted = F.expr("shiftleft(o_orderkey, cast(o_orderkey % 41 as int)) * if(o_orderkey % 7 = 0, -1L, 1L)")
    sizes = orders.withColumn("size_bytes", shifted)
    return sizes.withColumn("size", size_pretty(F.col("size_bytes")))


def q_threat_score(spark, sf_dir):
    return TH.threat_score(_store(spark, sf_dir), FX.intelligence(spark, sf_dir))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "line_class_counts": q_line_class_counts,
    "valid_lines": q_valid_lines,
    "flagged_lines": q_flagged_lines,
    "extract_all_lines": q_extract_all_lines,
    "insert_rejects": q_insert_rejects,
    "ingest_newest_first": q_ingest_newest_first,
    "ingest_oldest_first": q_ingest_oldest_first,
    "ingest_incremental": q_ingest_incremental,
    "seen_source_ips": q_seen_source_ips,
    "geo_candidates": q_geo_candidates,
    "geo_decode": q_geo_decode,
    "geo_errors": q_geo_errors,
    "geo_enrich_run": q_geo_enrich_run,
    "geo_upsert": q_geo_upsert,
    "enriched_logs": q_enriched_logs,
    "logs_page": q_logs_page,
    "logs_page_offset": q_logs_page_offset,
    "geo_lookup": q_geo_lookup,
    "geo_lookup_bulk": q_geo_lookup_bulk,
    "table_stats": q_table_stats,
    "table_row_counts": q_table_row_counts,
    "database_size": q_database_size,
    "run_counters": q_run_counters,
    "run_summary": q_run_summary,
    "ip_summary": q_ip_summary,
    "first_last_seen": q_first_last_seen,
    "top_sources": q_top_sources,
    "top_ports": q_top_ports,
    "attack_trend": q_attack_trend,
    "attack_trend_hourly": q_attack_trend_hourly,
    "attack_trend_stream": q_attack_trend_stream,
    "seen_state": q_seen_state,
    "frequent_sources": q_frequent_sources,
    "stream_ingest": q_stream_ingest,
    "stream_replayed": q_stream_replayed,
    "stream_growing_file": q_stream_growing_file,
    "ingest_rerun_stored": q_ingest_rerun_stored,
    "logs_page_stored": q_logs_page_stored,
    "logs_page_after": q_logs_page_after,
    "geo_lookup_stored": q_geo_lookup_stored,
    "geo_merge_stored": q_geo_merge_stored,
    "geo_lookup_buckets": q_geo_lookup_buckets,
    "answers_from_json": q_answers_from_json,
    "json_sink_round_trip": q_json_sink_round_trip,
    "geo_upsert_duplicates": q_geo_upsert_duplicates,
    "size_pretty_values": q_size_pretty_values,
    "threat_score": q_threat_score,
}


def _llm_queries() -> tuple[dict, dict]:
    """Queries and oracle SQL of the training-data operators; none where that subpackage is not installed."""
    try:
        import corpus_pipeline
        from firelog.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "firelog.llm"):
            raise
        return {}, {}
    found, sql = dict(llm.QUERIES), dict(llm.ORACLE_SQL)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship on sf0.001: lines -> triage -> ingest -> enrich -> per-address summary."""
    return queries()["ip_summary"](spark, SMOKE_DIR)


def _configured(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _configured(fn) for name, fn in {**_QUERIES, **_llm_queries()[0]}.items()}


def oracle_sql() -> dict[str, str]:
    from oracle_sql import build_all

    return {**build_all(), **_llm_queries()[1]}

"""End-to-end batch jobs: ingest a log, enrich new addresses, report counters.

The ingest run is idempotent: re-running it over the same (or a grown) log
adds only rows whose key is not stored yet, which is what makes a
twice-a-day re-read of the whole syslog safe.

Plan of one run (``run_ingest``):

1. text scan -> cheap flag test -> ten regex searches and timestamp parse
   per candidate line (narrow, no shuffle);
2. the flagged rows are written once to a staging table under the shared
   checkpoint folder -- the regex work is never repeated, the lineage is cut
   there, and a lost executor only re-runs its own scan tasks;
3. rejected rows -> rejects table (optional);
4. accepted rows -> per-key winner (one hash shuffle on the key, partially
   aggregated per task) -> the winners dealt into the store's buckets ->
   anti-join with the stored keys of the staging's days, bucket by bucket (the
   stored side is not shuffled) -> written under the batch's id;
5. rows, rejects and counters become visible together, when the ledger names
   the batch (``sources.store``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.operators import geo as G
from firelog.operators import ingest as I
from firelog.operators.fence import fence
from firelog.operators.triage import flagged_candidates, parse_lines
from firelog.session import configure, scratch_path
from firelog.sources import geo_store as GS
from firelog.sources import store as ST
from firelog.sources import summaries as SM
from firelog.sources import tables as TB
from firelog.sources.files import delete
from firelog.sources.lines import read_log_lines


def _observed(observation: Observation) -> dict:
    """Observed values; none where adaptive execution saw that there are no rows and left the observation out."""
    return observation.get if observation._jo.getRow().length() else {}


def ingest_lines(spark: SparkSession, lines: DataFrame, store_path: str, order: str = "newest",
                 rejects_path: str | None = None, keep_staging: bool = False,
                 classify_all: bool = True, batch: str | None = None, buckets: int | None = None,
                 summaries_path: str | None = None) -> tuple[dict, DataFrame | None]:
    """Ingest one batch of ``(line_no, line)`` into the store at ``store_path``.

    ``batch`` names the batch in the store's ledger (default: a new name). A
    batch that is committed already is not run again: its counters are
    returned as they were. ``buckets`` is used when the store is made.
    ``summaries_path`` keeps the store's summaries (``sources.summaries``); it
    must be given for every batch of a store or for none.

    Returns the run counters (lines_read, malformed, benign, flagged,
    errors, inserted, duplicates -- all observed while the staging table and
    the store are written, no extra pass) and ``staging`` (path of the
    flagged rows, used by the enrichment step; kept when ``keep_staging``).

    ``classify_all=False`` skips the regex searches on lines that fail the
    cheap flag test: the store is the same, ``lines_read`` and ``flagged``
    are still counted, but benign and malformed are not told apart (both
    reported as None). On logs where few lines are threats this removes most
    of the per-line work.
    """
    configure(spark)
    batch = batch or f"run-{uuid.uuid4().hex}"
    known = ST.committed_counters(spark, store_path, batch)
    if known is not None:
        return dict(known), None
    n_buckets = ST.start_batch(spark, store_path, batch, buckets, (rejects_path,) if rejects_path else ())
    cls = F.col("line_class")
    obs_lines = Observation("firelog_lines")
    if classify_all:
        parsed = parse_lines(lines).observe(
            obs_lines,
            F.count(F.lit(1)).alias("lines_read"),
            F.count_if(cls == "malformed").alias("malformed"),
            F.count_if(cls == "benign").alias("benign"),
            F.count_if(cls == "flagged").alias("flagged"),
        )
    else:
        counted = lines.observe(obs_lines, F.count(F.lit(1)).alias("lines_read"))
        parsed = parse_lines(flagged_candidates(counted))
    flagged_rows = parsed.where(cls == "flagged").drop("line_class")
    obs_flagged = Observation("firelog_flagged")
    if not classify_all:
        flagged_rows = flagged_rows.observe(obs_flagged, F.count(F.lit(1)).alias("flagged"))
    rows = fence(I.to_store_rows(flagged_rows))
    reject = F.col("reject_reason")
    obs_rows = Observation("firelog_rows")
    rows = rows.observe(
        obs_rows,
        F.count_if(reject.isNotNull()).alias("errors"),
        F.count_if(reject.isNull()).alias("accepted"),
    )

    staging = scratch_path(spark, "firelog-staging")
    try:
        rows.write.mode("errorifexists").parquet(staging)
        staged = spark.read.parquet(staging)
        if rejects_path:
            ST.write_rejects(I.rejected(staged), rejects_path, batch)
        acc = I.accepted(staged)
        new_rows = I.insert_if_absent(acc, I.restrict_store_to(ST.read_log_store(spark, store_path), acc), order, buckets=n_buckets)
        obs_new = Observation("firelog_inserted")
        ST.write_rows(new_rows.observe(obs_new, F.count(F.lit(1)).alias("inserted")), store_path, batch)

        if summaries_path:
            SM.write_share(spark, store_path, summaries_path, batch)
        counts = dict(obs_lines.get)
        if not classify_all:
            counts.update(flagged=obs_flagged.get.get("flagged", 0), malformed=None, benign=None)
        totals = obs_rows.get
        counts["errors"] = totals["errors"]
        counts["inserted"] = _observed(obs_new).get("inserted", 0)
        counts["duplicates"] = totals["accepted"] - counts["inserted"]
        counts["processed"] = counts["flagged"]
        ST.commit(spark, store_path, batch, counts)
    except BaseException:
        delete(spark, staging)
        raise
    if keep_staging:
        counts["staging"] = staging
        return counts, staged
    delete(spark, staging)
    return counts, None


def run_ingest(spark: SparkSession, log_path: str | list[str], store_path: str, order: str = "newest",
               rejects_path: str | None = None, classify_all: bool = True,
               long_lines: str = "keep", batch: str | None = None, buckets: int | None = None) -> dict[str, int]:
    """Read log text files and ingest them (see module docstring).

    ``long_lines='fail'`` stops the run at the first line beyond 64 KiB.
    """
    lines = read_log_lines(spark, log_path, long_lines=long_lines)
    counts, _ = ingest_lines(spark, lines, store_path, order, rejects_path, classify_all=classify_all, batch=batch, buckets=buckets)
    return counts


def _geo_counts(fetched: DataFrame) -> dict[str, int]:
    counts = fetched.agg(
        F.count(F.lit(1)).alias("geo_candidates"),
        F.count_if(F.col("geo_error").isNull()).alias("geo_completed"),
        F.count_if(F.col("geo_error").isNotNull()).alias("geo_errors"),
    ).first().asDict()
    counts["geo_queued"] = counts["geo_candidates"] - counts["geo_completed"] - counts["geo_errors"]
    return counts


def run_enrichment(spark: SparkSession, flagged_rows: DataFrame, geo_in: str | None, answers: DataFrame,
                   geo_out: str, as_of: str) -> dict[str, int]:
    """Look up the new source addresses of ``flagged_rows`` and write the
    merged geo table as a new version at ``geo_out``.

    The candidate list is written to scratch first (distinct new addresses),
    so that the planner knows its size and may broadcast it when filtering
    the answers.
    """
    configure(spark)
    geo = TB.read_geo_table(spark, geo_in)
    cands_path = scratch_path(spark, "firelog-geo-candidates")
    G.geo_candidates(G.seen_source_ips(flagged_rows), geo).write.parquet(cands_path)
    cands = spark.read.parquet(cands_path)
    fetched_path = scratch_path(spark, "firelog-geo-fetched")
    G.fetch(cands, answers).write.parquet(fetched_path)
    fetched = spark.read.parquet(fetched_path)
    TB.write_geo_table(G.upsert_geo(geo, G.as_geo_rows(fetched, as_of)), geo_out)
    counts = _geo_counts(fetched)
    delete(spark, fetched_path)
    delete(spark, cands_path)
    return counts


def run_enrichment_into(spark: SparkSession, flagged_rows: DataFrame, geo_path: str, answers: DataFrame, as_of: str,
                        buckets: int | None = None) -> dict[str, int]:
    """Look up the new source addresses of ``flagged_rows`` and merge them into the bucketed geo table at ``geo_path``.

    Only the buckets of seen addresses are read and only those of new rows
    rewritten (``sources.geo_store``). Counters as ``run_enrichment``, and
    ``geo_buckets``, the number of buckets rewritten.
    """
    configure(spark)
    GS.create(spark, geo_path, buckets)
    seen_path, fetched_path = scratch_path(spark, "firelog-geo-seen"), scratch_path(spark, "firelog-geo-fetched")
    try:
        G.seen_source_ips(flagged_rows).write.parquet(seen_path)
        seen = spark.read.parquet(seen_path)
        G.fetch(G.geo_candidates(seen, GS.read_of(spark, geo_path, seen, "source_ip")), answers).write.parquet(fetched_path)
        fetched = spark.read.parquet(fetched_path)
        counts = _geo_counts(fetched)
        counts["geo_buckets"] = len(GS.merge(G.as_geo_rows(fetched, as_of), geo_path))
    finally:
        delete(spark, seen_path)
        delete(spark, fetched_path)
    return counts


def run(spark: SparkSession, log_path: str | list[str], store_path: str, answers: DataFrame,
        geo_in: str | None, geo_out: str, as_of: str, order: str = "newest",
        rejects_path: str | None = None, classify_all: bool = True,
        long_lines: str = "keep") -> dict[str, int]:
    """Ingest + enrichment; returns all run counters."""
    lines = read_log_lines(spark, log_path, long_lines=long_lines)
    counts, staged = ingest_lines(spark, lines, store_path, order, rejects_path, keep_staging=True,
                                  classify_all=classify_all)
    staging = counts.pop("staging")
    counts.update(run_enrichment(spark, staged, geo_in, answers, geo_out, as_of))
    delete(spark, staging)
    return counts


def summary_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counters as ``(metric, value)`` rows in summary order."""
    from firelog.operators.report import RUN_METRICS

    rows = [(m, None if counts[m] is None else int(counts[m])) for m in RUN_METRICS if m in counts]
    return spark.createDataFrame(rows, "metric string, value bigint")


__all__ = ["ingest_lines", "run_ingest", "run_enrichment", "run_enrichment_into", "run", "summary_frame"]

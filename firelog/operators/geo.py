"""Geolocation enrichment: new addresses, provider answers, geo table merge.

The provider is any DataFrame of answers ``(ip, status_code, body)`` -- a
bulk export or a table of responses fetched elsewhere. An address is looked
up once: only source addresses of flagged lines that are not yet in the geo
table are candidates. A candidate without a usable answer stays absent and
is a candidate again on the next run; an answer that decodes (even an empty
"fail" body with status 200) is stored and never asked again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.functions import geojson as J

DECODED_COLUMNS = ("country", "region", "city", "isp", "latitude", "longitude", "geo_error")


def seen_source_ips(rows: DataFrame) -> DataFrame:
    """Distinct source addresses of flagged lines (``source_ip``).

    Includes lines whose insert was rejected or was a duplicate.
    """
    return rows.select("source_ip").distinct()


def geo_candidates(seen: DataFrame, geo: DataFrame) -> DataFrame:
    """Seen addresses with no geo row yet (``ip``)."""
    known = geo.select(F.col("ip_address").alias("ip"))
    return seen.select(F.col("source_ip").alias("ip")).join(known, "ip", "left_anti")


def decode_answers(answers: DataFrame) -> DataFrame:
    """Answers with the decoded attributes and ``geo_error`` added.

    Staged: the body is parsed once into a VARIANT, then the value of each
    key, its JSON kind, the error, the attributes -- each its own projection.
    """
    parsed = answers.withColumn("_v", J.parse_body(F.col("body")))
    subs = J.answer_fields(F.col("_v"), F.col("body"))
    with_subs = parsed.select("*", *[c.alias(f"_f{n}") for n, c in subs.items()])
    fcols = {n: F.col(f"_f{n}") for n in subs}
    kinds = J.answer_kinds(F.col("_v"), fcols)
    with_kinds = with_subs.select("*", *[k.alias(f"_k{n}") for n, k in kinds.items()])
    kcols = {n: F.col(f"_k{n}") for n in kinds}
    with_err = with_kinds.withColumn("geo_error", J.answer_error(F.col("status_code"), F.col("_v"), kcols))
    values = J.answer_values(fcols, kcols)
    ok = F.col("geo_error").isNull()
    return with_err.select(
        *answers.columns,
        *[F.when(ok, values[n]).alias(n) for n in DECODED_COLUMNS if n != "geo_error"],
        "geo_error",
    )


def fetch(candidates: DataFrame, answers: DataFrame) -> DataFrame:
    """Each candidate with its decoded answer: ``(ip, attributes..., geo_error)``.

    A candidate without an answer gets ``geo_error = 'no answer'``. Only the
    candidates' answers are kept and decoded. Of several answers for one
    address one with status 200 wins, then the larger status, then the larger
    body (so the choice does not depend on the order of rows).
    """
    ans = answers.select("ip", "status_code", "body").join(candidates.select("ip"), "ip", "left_semi")
    best = F.max(F.struct((F.col("status_code") == 200).alias("ok"), "status_code", "body")).alias("a")
    ans = ans.groupBy("ip").agg(best).select("ip", "a.status_code", "a.body")
    joined = candidates.join(ans, "ip", "left")
    return decode_answers(joined).select("ip", *DECODED_COLUMNS)


def as_geo_rows(fetched: DataFrame, as_of: str) -> DataFrame:
    """Successful lookups as geo table rows stamped ``last_updated = as_of``."""
    ok = fetched.where(F.col("geo_error").isNull())
    return ok.select(
        F.col("ip").alias("ip_address"),
        *[F.col(c) for c in S.GEO_ATTRIBUTES],
        F.lit(as_of).cast("timestamp_ntz").alias("last_updated"),
    )


def upsert_geo(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Geo table after merging ``new_rows``: a new row replaces every
    attribute of an existing row with the same address, else it is added.
    One aggregation over both, one row per address: a new row wins over an
    existing one; of several on one side the one last updated, then the one
    with the larger attributes."""
    rest = [c for c in S.GEO_COLUMNS if c not in ("ip_address", "last_updated")]
    both = existing.select(F.lit(0).alias("_new"), *S.GEO_COLUMNS).unionByName(
        new_rows.select(F.lit(1).alias("_new"), *S.GEO_COLUMNS))
    best = both.groupBy("ip_address").agg(F.max(F.struct("_new", "last_updated", *rest)).alias("_b"))
    return best.select(*[F.col(c) if c == "ip_address" else F.col(f"_b.{c}") for c in S.GEO_COLUMNS])


def enrich(rows: DataFrame, geo: DataFrame, answers: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """One enrichment run for the flagged ``rows`` of a batch.

    Returns ``seen``, ``candidates``, ``fetched`` (with ``geo_error``),
    ``new_rows`` and ``geo`` (the merged table to write as a new version).
    """
    seen = seen_source_ips(rows)
    cands = geo_candidates(seen, geo)
    fetched = fetch(cands, answers)
    new_rows = as_geo_rows(fetched, as_of)
    return {
        "seen": seen,
        "candidates": cands,
        "fetched": fetched,
        "new_rows": new_rows,
        "geo": upsert_geo(geo, new_rows),
    }

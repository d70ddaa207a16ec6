"""Three-way triage of log lines and field extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelog import schemas as S
from firelog.functions import extract as X
from firelog.operators.fence import fence


def parse_lines(lines: DataFrame, line_col: str = "line", fenced: bool = True) -> DataFrame:
    """Lines -> lines + ``line_class`` + the ten typed fields.

    ``line_class`` is malformed (a field is missing), flagged or benign. Each
    of the ten patterns is searched once per line: the raw matches are one
    projection, class and typed fields a second one that reads them. With
    ``fenced`` the result is evaluated before any later filter (see
    :mod:`firelog.operators.fence`).
    """
    line = F.col(line_col)
    raw = X.raw_fields(line)
    staged = lines.select("*", *[raw[n].alias(f"_raw_{n}") for n in X.FIELD_ORDER])
    r = {n: F.col(f"_raw_{n}") for n in X.FIELD_ORDER}
    cls = (
        F.when(~X.is_valid_from_raw(r), F.lit("malformed"))
        .when(X.is_flagged(line), F.lit("flagged"))
        .otherwise(F.lit("benign"))
    )
    typed = X.typed_from_raw(r)
    keep = [c for c in lines.columns]
    parsed = staged.select(*keep, cls.alias("line_class"), *[typed[n].alias(n) for n in X.FIELD_ORDER])
    return fence(parsed) if fenced else parsed


def classify(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Alias of :func:`parse_lines` (class plus fields, evaluated once)."""
    return parse_lines(lines, line_col)


def flagged_candidates(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines that pass the cheap substring flag test (a superset of flagged).

    Runs before any regex: only these lines need field extraction on the
    ingest path. Malformed ones among them are dropped after parsing.
    """
    return lines.where(X.is_flagged(F.col(line_col)))


def class_counts(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``(line_class, lines)`` for all three classes (zero rows included)."""
    counted = classify(lines, line_col).groupBy("line_class").agg(F.count("*").alias("lines"))
    classes = lines.sparkSession.createDataFrame([(c,) for c in S.LINE_CLASSES], "line_class string")
    return classes.join(F.broadcast(counted), "line_class", "left").select(
        "line_class", F.coalesce("lines", F.lit(0).cast("bigint")).alias("lines")
    )

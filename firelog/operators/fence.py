"""Evaluation fence: compute every column once, filter afterwards.

Catalyst pushes a filter below the projection that defines the filtered
columns by substituting their expressions. For cheap expressions that is
what we want; for the ten regex searches and the timestamp parse of a log
line it means evaluating them twice (once in the filter, again in the
projection) and, stacked, produces generated code beyond the JVM's 64 KB
method limit. Routing the columns through ``inline(array(struct(...)))`` (a
one-row ``Generate``) stops the pushdown there: filters on its output cannot
move below it, and it runs inside whole-stage codegen at the cost of one
small array per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame) -> DataFrame:
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))

"""Joining log rows to a per-IP dimension table.

The dimension (geo rows, one per IP) grows with the number of distinct
addresses ever seen, so nothing is broadcast by hint: adaptive execution
measures both sides after their shuffles and broadcasts one only if its bytes
are below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it
splits the partition of a hot address (a single scanner may send a third of
all lines) into several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left") -> DataFrame:
    """``fact`` joined to a dimension unique on ``on``."""
    return fact.join(dim, on, how)

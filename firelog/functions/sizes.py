"""Human-readable byte sizes in the style of PostgreSQL's ``pg_size_pretty``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names and thresholds of pg_size_pretty.
_BYTES_LIMIT = 10 * 1024
_UNIT_LIMIT = 20 * 1024 - 1
_UNITS = ("kB", "MB", "GB", "TB", "PB")


def size_pretty(size_bytes: Column) -> Column:
    """``8192 bytes``, ``16 kB``, ``120 MB`` ...

    Below 10240 bytes the exact count is shown. Above, the value is kept in
    half-units (bytes >> 9, then >> 10 per unit) so that the last step can
    round half away from zero, and a unit is used while the value stays
    below 20479 of its half-units. Computed on the magnitude (division
    truncating toward zero and symmetric rounding make the sign separable).
    """
    b = size_bytes.cast("bigint")
    sign = F.when(b < 0, F.lit("-")).otherwise(F.lit(""))
    a = F.abs(b)

    def shown(x: Column, unit: str) -> Column:
        return F.concat(sign, F.shiftright(x + 1, 1).cast("string"), F.lit(" " + unit))

    expr = F.when(a < _BYTES_LIMIT, F.concat(b.cast("string"), F.lit(" bytes")))
    half = F.shiftright(a, 9)
    for i, unit in enumerate(_UNITS):
        if i == len(_UNITS) - 1:
            return expr.otherwise(shown(half, unit))
        expr = expr.when(half < _UNIT_LIMIT, shown(half, unit))
        half = F.shiftright(half, 10)
    return expr

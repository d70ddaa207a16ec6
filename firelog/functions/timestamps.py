"""Timestamp text <-> zone-less timestamp conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digit(c: Column) -> Column:
    return c.between("0", "9")


def _exact_parse(text: Column) -> Column:
    """Slow path for the rare texts a plain cast gets wrong (see below)."""
    n = F.length(text)
    zone_sign = F.substring(text, -6, 1)
    base = (
        F.when(text.endswith("Z"), text.substr(F.lit(1), n - 1))
        .when(zone_sign.isin("+", "-"), text.substr(F.lit(1), n - 6))
        .otherwise(text)
    )
    hour = F.substring(base, 12, 2)
    minute = F.substring(base, 15, 2)
    second = F.substring(base, 18, 2)
    frac = F.when(F.length(base) > 20, base.substr(F.lit(21), F.length(base) - 20)).otherwise(F.lit(""))
    frac_is_zero = F.ltrim(frac, F.lit("0")) == ""

    is_24 = (hour == "24") & (minute == "00") & (second == "00") & frac_is_zero
    is_60 = second == "60"
    core_text = F.concat(
        F.substring(base, 1, 10),
        F.lit(" "),
        F.when(is_24, F.lit("00")).otherwise(hour),
        F.lit(":"),
        minute,
        F.lit(":"),
        F.when(is_60, F.lit("59")).otherwise(second),
    )
    core = core_text.try_cast("timestamp_ntz")
    micros6 = F.rpad(F.substring(frac, 1, 6), 6, "0").try_cast("bigint")
    round_up = (F.length(frac) > 6) & (F.substring(frac, 7, 1) >= F.lit("5"))
    micros = F.coalesce(micros6, F.lit(0)) + F.when(round_up, 1).otherwise(0)
    extra_seconds = (
        micros.cast("decimal(18,6)") / F.lit(1000000) + F.when(is_60, 1).otherwise(0)
    ).cast("decimal(18,6)")
    return core + F.make_dt_interval(F.when(is_24, 1).otherwise(0), F.lit(0), F.lit(0), extra_seconds)


def normalise_timestamp(text: Column) -> Column:
    """Parse an extracted timestamp into ``TIMESTAMP_NTZ``; NULL if invalid.

    The text is a match of the timestamp pattern,
    ``YYYY-MM-DDTHH:MM:SS[.f+][+hh:mm|Z]``, or ``unknown``. Rules of a
    zone-less SQL timestamp column:

    * the zone suffix is ignored (wall-clock time is kept) -- a plain
      ``try_cast`` does exactly this and is the fast path for almost all
      lines;
    * fractions beyond microseconds are rounded half-up (a cast truncates);
    * ``24:00:00`` is midnight of the next day, second 60 rolls into the
      next minute (a cast returns NULL);
    * impossible dates and year 0000 are invalid (a cast accepts year 0).
    """
    year0 = F.substring(text, 1, 4) == "0000"
    special = (
        (F.substring(text, 12, 2) == "24")
        | (F.substring(text, 18, 2) == "60")
        | ((F.substring(text, 20, 1) == ".") & _digit(F.substring(text, 27, 1)))
    )
    return (
        F.when(year0, F.lit(None).cast("timestamp_ntz"))
        .when(special, _exact_parse(text))
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def timestamp_text(ts: Column) -> Column:
    """RFC 3339 text of a zone-less timestamp read as UTC, fraction zeros trimmed.

    ``2025-01-05 00:01:08.1`` -> ``2025-01-05T00:01:08.1Z``;
    ``2025-01-05 00:01:08`` -> ``2025-01-05T00:01:08Z``.
    """
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    trimmed = F.regexp_replace(F.regexp_replace(full, r"0+$", ""), r"\.$", "")
    return F.concat(trimmed, F.lit("Z"))

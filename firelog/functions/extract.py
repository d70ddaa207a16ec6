"""Field extraction, validity and flag predicates for one syslog line.

All functions return ``Column`` expressions made of ``regexp_extract``,
``contains`` and casts, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from firelog import schemas as S

# name -> (pattern, group); group 0 is the whole match.
_RAW_FIELDS = {
    "timestamp": (S.TIMESTAMP_PATTERN, 0),
    "source_ip": (S.SRC_PATTERN, 1),
    "destination_ip": (S.DST_PATTERN, 1),
    "source_port": (S.SPT_PATTERN, 1),
    "destination_port": (S.DPT_PATTERN, 1),
    "protocol": (S.PROTO_PATTERN, 1),
    "action": (S.ACTION_PATTERN, 1),
    "reason": (S.REASON_PATTERN, 1),
    "packet_length": (S.LEN_PATTERN, 1),
    "ttl": (S.TTL_PATTERN, 1),
}
TEXT_FIELDS = ("timestamp", "source_ip", "destination_ip", "protocol", "action", "reason")
NUMBER_FIELDS = ("source_port", "destination_port", "packet_length", "ttl")
FIELD_ORDER = tuple(_RAW_FIELDS)


def raw_field(line: Column, name: str) -> Column:
    """First match of a field pattern, ``''`` when absent."""
    pattern, group = _RAW_FIELDS[name]
    return F.regexp_extract(line, pattern, group)


def raw_fields(line: Column) -> dict[str, Column]:
    return {name: raw_field(line, name) for name in _RAW_FIELDS}


def non_empty(text: Column, default: str = S.UNKNOWN) -> Column:
    """``default`` for the empty string, the text otherwise."""
    return F.when(text == "", F.lit(default)).otherwise(text)


def safe_long(digits: Column) -> Column:
    """Signed 64-bit value of a digit string; 0 if empty or out of range."""
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def is_valid_from_raw(raw: dict[str, Column]) -> Column:
    """A line is well formed when all ten fields are found.

    Every pattern needs at least one character in its captured text, so
    "found" is the same as "extracted text is non-empty"; this way each
    regex runs once per line instead of twice.
    """
    cond = None
    for name in _RAW_FIELDS:
        c = raw[name] != ""
        cond = c if cond is None else (cond & c)
    return cond


def is_valid(line: Column) -> Column:
    return is_valid_from_raw(raw_fields(line))


def is_flagged(line: Column, reasons: Iterable[str] = S.FLAGGED_REASONS) -> Column:
    """``action=DROP`` somewhere in the line and any flag word anywhere."""
    any_reason = None
    for word in reasons:
        c = line.contains(word)
        any_reason = c if any_reason is None else (any_reason | c)
    if any_reason is None:
        return F.lit(False)
    return line.contains(S.DROP_MARKER) & any_reason


def typed_from_raw(raw: dict[str, Column]) -> dict[str, Column]:
    """The ten extracted fields: text defaults to ``unknown``, numbers to 0."""
    out = {}
    for name in FIELD_ORDER:
        if name in NUMBER_FIELDS:
            out[name] = safe_long(raw[name])
        else:
            out[name] = non_empty(raw[name])
    return out


def extract_fields(line: Column) -> list[Column]:
    """The ten fields of a line as aliased columns (usable on any line)."""
    typed = typed_from_raw(raw_fields(line))
    return [typed[name].alias(name) for name in FIELD_ORDER]

"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from firelog.functions.extract import (
    extract_fields,
    is_flagged,
    is_valid,
    non_empty,
    safe_long,
)
from firelog.functions.timestamps import normalise_timestamp, timestamp_text
from firelog.functions.sizes import size_pretty

__all__ = [
    "extract_fields",
    "is_flagged",
    "is_valid",
    "non_empty",
    "safe_long",
    "normalise_timestamp",
    "timestamp_text",
    "size_pretty",
]

"""Shared helpers of the text operators: Arrow batches, code points, hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from firelog.session import scratch_path

# Text bytes handled at once inside a task; a longer single text forms a slice of its own.
SLICE_BYTES = 1 << 20

_U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, records: int = 1000) -> None:
    """Rows per Arrow batch between JVM and Python: keeps a batch of long texts within worker memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared scratch folder and read again (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def release_memory() -> None:
    """Free memory goes back to the system, so that idle Python workers do not hold what a task needed."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def sliced(batch: pa.RecordBatch, column: int | str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of about ``max_bytes`` of text each (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def map_slices(df: DataFrame, column: int | str, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema,
               max_bytes: int = SLICE_BYTES) -> DataFrame:
    """``fn`` over byte-balanced slices of every partition (Arrow in, Arrow out)."""
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for part in sliced(batch, column, max_bytes):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
        release_memory()

    return df.mapInArrow(run, schema)


def by_slices(texts: pa.Array, fn: Callable[[pa.Array], pa.Array], kind: pa.DataType, max_bytes: int = SLICE_BYTES) -> pa.Array:
    """``fn`` over byte-balanced slices of a text column, for Arrow functions that see the texts only."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    out = pa.concat_arrays([pa.array([], kind), *(fn(part.column(0)) for part in sliced(batch, 0, max_bytes))])
    release_memory()
    return out


def code_points(texts: list[str], sep: str = "\n") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one code-point array, ``sep`` after each: (points, first index, one past the last)."""
    data = np.frombuffer((sep.join(texts) + sep).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + len(sep))[:-1]]) if len(texts) else np.zeros(0, np.int64)
    return data, starts.astype(np.int64), (starts + lengths).astype(np.int64)


_ALPHA: list[np.ndarray] = []


def alpha_table() -> np.ndarray:
    """Whether each code point is a letter (built once per process)."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing function (xor-shift and multiply)."""
    x = np.asarray(x, _U64)
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    got = _POW.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        factors = np.full(size, base, _U64)
        factors[0] = 1
        got = np.cumprod(factors, dtype=_U64)
        if size <= 1 << 22:
            _POW[base] = got
    return got[:n]


class RangeHash:
    """Hashes of arbitrary ranges of a code-point array.

    Prefix sums of ``mix(point) * BASE**position`` modulo 2**64; a range is
    the difference of two prefix sums shifted back by the inverse power, so
    equal ranges hash alike wherever they stand.
    """

    def __init__(self, points: np.ndarray):
        n = len(points)
        with np.errstate(over="ignore"):
            terms = mix(points.astype(_U64) + _U64(1)) * _powers(_BASE, n)
            self.sums = np.concatenate([np.zeros(1, _U64), np.cumsum(terms, dtype=_U64)])
        self.back = _powers(_BASE_INV, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(_U64))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every run of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))

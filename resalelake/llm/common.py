"""Helpers shared by the operators: tables, written stages, row keys and bytes of text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from resalelake.session import released, shared_folder  # noqa: F401  released: for the operators


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and a lost executor loses nothing of it."""
    path = shared_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def given_back() -> None:
    """Give memory that a worker has freed back to the system: workers outlive their tasks, and share an executor with its JVM."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU library
        trim(0)


def names_kept(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of their input: columns named like those the operator makes for itself (``__``...)
    keep their names and values. A column that the operator adds under a name that is taken gets underscores at its end."""

    @wraps(operator)
    def kept(docs: DataFrame, *args, **kwargs) -> DataFrame:
        taken = [c for c in docs.columns if c.startswith("__")]
        if not taken:
            return operator(docs, *args, **kwargs)
        aside = {c: f"aside {n}" for n, c in enumerate(taken)}
        out = operator(docs.withColumnsRenamed(aside), *args, **kwargs)
        own = {c: free_name(c, [*taken, *out.columns]) for c in out.columns if c in aside}
        return out.withColumnsRenamed(own).withColumnsRenamed({new: old for old, new in aside.items()})

    return kept


def free_name(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def with_key(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Add ``__k1, __k2``: equal for repeated rows only. Never null, so plain equality joins work with null ids, which come first."""
    return docs.withColumns(
        {
            "__k1": F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63)).cast("long")),
            "__k2": F.xxhash64(F.col(id_column).isNull(), F.col("text")),
        }
    )


KEY = ["__k1", "__k2"]


def crc32_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes in each; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = np.asarray(pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 booleans, true in the given inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Not white space: words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of text with lower-cased A-Z.
ALNUM = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8) + 32 * byte_class((0x41, 0x5A)).astype(np.uint8)


def spans(raw: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word (a longest run of ``wanted`` bytes within one text) and the first word of each text."""
    inside = wanted[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        base, inverse = int(_ODD), pow(int(_ODD), -1, 1 << 64)
        for name, factor in (("up", base), ("down", inverse)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_sums(raw: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any span follows."""
    up, _ = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return sums


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes anywhere."""
    sums = span_sums(raw) if sums is None else sums
    _, down = _power_tables(len(raw) + 1)
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

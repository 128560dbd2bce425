"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release_memory() -> None:
    """Give memory that nothing uses back to the system: Arrow's pool and the C
    library both keep it, and Spark reuses its Python workers for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc's
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with a task's memory given back at its end."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()
    return task


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an Arrow string column without copying each
    text: nulls are empty.  ``offsets`` has one entry more than there are rows
    and starts at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches so that the texts of one hold about ``max_bytes``
    (one longer text stays whole)."""
    for batch in batches:
        _, offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def id_remainder(column: str, modulus: int):
    """crc32 of the decimal text of an id, modulo ``modulus`` (null id: null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Maximal runs of the bytes with ``inside`` in each text of a buffer: the
    row of every run, its first byte, and the runs themselves as an Arrow array.
    ``inside`` is a table of 256 flags."""
    within = inside[data]
    begin = within.copy()
    begin[1:] &= ~within[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begin[heads] = within[heads]
    first = np.flatnonzero(begin)
    kept = data[within]
    before = np.cumsum(within, dtype=np.int32)
    bounds = np.append(before[first] - 1, len(kept)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
    return np.searchsorted(offsets, first, side="right") - 1, first, runs


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text have their flag set."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]

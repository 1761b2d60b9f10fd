"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from worksledger.session import scratch_path

#: Texts are handled in pieces of about this many bytes, whatever the size of a batch.
PIECE_BYTES = 2 << 20

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
GOLDEN = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, name: str, rows_together: int | None = None) -> DataFrame:
    """df, written once below the shared folder and read from there.

    Writers and readers hold a row group at a time, which Parquet lets grow to 100 rows before
    it looks at their size; rows_together bounds it for tables whose rows are megabytes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write if rows_together is None else df.write.option("parquet.block.row.count.limit", rows_together)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit words with good diffusion."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def pieces(batch: pa.RecordBatch, column: int, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about `size` bytes of text each, one row at least."""
    lengths = batch.column(column).cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(lengths.buffers()[1], dtype=np.int64)[lengths.offset :][: len(lengths) + 1]
    start = 0
    while start < len(lengths):
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), len(lengths))
        yield batch.slice(start, end - start)
        start = end


#: Tables that a worker keeps from task to task; each can be emptied at any time.
TABLES: list[dict] = []


def forget() -> None:
    """Empty the tables that earlier stages left in this worker, for a stage that needs none of them."""
    for held in TABLES:
        held.clear()


def give_back() -> None:
    """Return freed memory to the system: workers live on, and the next stage needs it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only the C library of Linux has this
        ctypes.CDLL(None).malloc_trim(0)


def map_texts(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: int = 1, size: int = PIECE_BYTES
) -> DataFrame:
    """Apply work to bounded slices of df; column is the place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, column, size):
                out = work(piece)
                if out is not None and out.num_rows:
                    yield out
        give_back()

    return df.mapInArrow(run, schema)


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts after one another, and where each begins (one more at the end)."""
    raw = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset :][: len(raw) + 1]
    data = raw.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(raw) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. lengths[0]-1, 0, 1, .. lengths[1]-1, and so on."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - lengths, lengths)

"""Small helpers the operators share: reading tables, walking Arrow batches in bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows of one slice, and bytes of text in it unless a single row is longer.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, column: str, rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Each batch cut so that a slice's text in `column` stays near `size` bytes; every row once."""
    for batch in batches:
        lengths = np.array(
            [0 if v is None else v for v in pc.binary_length(batch.column(column)).to_pylist()],
            np.int64,
        )
        at = 0
        while at < len(lengths):
            ends = np.cumsum(lengths[at : at + rows])
            n = max(1, int(np.searchsorted(ends, size, "right")))
            yield batch.slice(at, n)
            at += n


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes end to end, and each row's start with the total at the end."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    lengths = pc.binary_length(filled).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    if not starts[-1]:
        return np.zeros(0, np.uint8), starts
    first = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset]
    data = np.frombuffer(filled.buffers()[2], np.uint8)[first : first + starts[-1]]
    return data, starts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every pair, end to end."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

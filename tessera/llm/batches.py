"""Arrow batches cut into slices of bounded text, and small helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text handled at a time inside a task; one longer row forms a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(column: pa.Array) -> int:
    """The bytes a string or binary column holds, without reading the values."""
    return column.nbytes


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches of about ``limit`` bytes; empty batches are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, min(batch.num_rows, batch.num_rows * limit // max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            if part.num_rows > 1 and part.nbytes > 2 * limit:
                half = part.num_rows // 2
                yield from slices(iter([part.slice(0, half), part.slice(half)]), limit)
            else:
                yield part


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of complete shards, from batches sorted by ``shard``, their first column."""
    held: list[pa.RecordBatch] = []

    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        shards = np.asarray(batch.column(0))
        # The rows come sorted by shard: all but the last shard of a batch are complete.
        cut = int(np.searchsorted(shards, shards[-1]))
        if cut:
            yield whole([*held, batch.slice(0, cut)])
            held = []
        elif held and np.asarray(held[0].column(0))[0] != shards[0]:
            yield whole(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield whole(held)


def shards_of(whole: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Start and end of every shard of more than one row."""
    shards = np.asarray(whole.column(0))
    starts = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1], [True])))
    for at in np.flatnonzero(np.diff(starts) > 1).tolist():
        yield int(starts[at]), int(starts[at + 1])

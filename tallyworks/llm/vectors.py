"""Reading embeddings: which vectors count, exact copies, and their numbers inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """A vector takes part if it has components, all of them finite numbers and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def as_doubles(vector: str) -> Column:
    """The components in double precision, with one zero instead of two."""
    return F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches cut into one table for each run of equal keys."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows - 1, dtype=bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            changed |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            part = batch.slice(start, end - start)
            if waiting and any(waiting[0].column(k)[0].as_py() != part.column(k)[0].as_py() for k in keys):
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(part)
    if waiting:
        yield pa.Table.from_batches(waiting)


def in_groups(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of a key side by side in one partition."""
    return frame.repartition(*keys).sortWithinPartitions(*keys, *order)

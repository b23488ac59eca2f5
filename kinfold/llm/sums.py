"""Sums of vectors over all rows; a fixed number of partial sums reaches the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinfold.llm.batches import in_arrow

PARTS = 8  # partial sums that reach the driver


def summed(rows: DataFrame, add: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of a vector of fixed ``size``.

    Each task sums its own rows; then groups of tasks are summed in rounds, each
    by the square root of their number, until at most ``PARTS`` are left.
    """

    def packed(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += add(batch)
        yield packed(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_py())
        yield packed(total)

    left = rows.rdd.getNumPartitions()
    totals = in_arrow(rows, first, "total binary")
    while left > PARTS:
        left = max(PARTS, ceil(sqrt(left))) if left > PARTS**2 else PARTS
        totals = in_arrow(totals.repartition(left), again, "total binary")
    return sum((np.frombuffer(bytes(row.total)) for row in totals.collect()), np.zeros(size))

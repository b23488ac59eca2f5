"""Jobs over vectors: resident rows and a stream of visitors that meets them, in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, no null and no non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _ends(batch: pa.RecordBatch, names: list[str]) -> list[int]:
    """The places after the last row of each run of equal values."""
    rows = batch.num_rows
    changed = np.zeros(max(rows - 1, 0), bool)
    for name in names:
        column = batch.column(name)
        changed |= pc.not_equal(column.slice(1), column.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
    return [*(np.flatnonzero(changed) + 1).tolist(), rows]


def streamed(batches: Iterator[pa.RecordBatch], group: list[str], open_job: Callable[[pa.Table], object]) -> Iterator[pa.RecordBatch]:
    """Feeds rows that are sorted by ``group`` and then ``visitor`` (0: resident, else a visitor) into one job after another.

    A job is opened with its resident rows, meets its visitors batch by batch
    through ``visit`` and ends with ``finish``; both may give batches. Only the
    resident rows and one batch of visitors are held.
    """
    current, resident, job = None, [], None

    def close():
        nonlocal job
        if job is None and resident:
            job = open_job(pa.Table.from_batches(resident))
        if job is not None:
            yield from job.finish()

    for batch in batches:
        if not batch.num_rows:
            continue
        start = 0
        for end in _ends(batch, [*group, "visitor"]):
            part = batch.slice(start, end - start)
            *key, visitor = (batch.column(name)[start].as_py() for name in (*group, "visitor"))
            start = end
            if key != current:
                yield from close()
                current, resident, job = key, [], None
            if not visitor:
                resident.append(part)
            elif resident or job is not None:
                if job is None:
                    job = open_job(pa.Table.from_batches(resident))
                yield from job.visit(part)
    yield from close()

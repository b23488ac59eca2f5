"""A function per text over Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROOT = str(Path(__file__).resolve().parents[2])
SLICE = 256  # rows turned into Python strings at once


def in_arrow(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package, where it is not installed on the executors' path."""
    environment = frame.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(path for path in [ROOT, *paths] if path)
    return frame.mapInArrow(run, schema)


def per_text(
    docs: DataFrame, build: Callable[[], Callable[[str], tuple]], fields: str, text: str = "text", keys: tuple = ("doc_id",)
) -> DataFrame:
    """``keys`` and the values of a function of the text, one row per row; a null text counts as empty.

    ``build`` runs once per task and gives that function. Nothing is shuffled,
    other columns are not read, and a lost task is simply run again.
    """
    narrow = docs.select(*keys, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    added = StructType.fromDDL(fields)
    schema = StructType([narrow.schema[key] for key in keys] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = [work(value) for value in part.column("_text").to_pylist()]
                columns = [part.column(key) for key in keys]
                columns += [pa.array(values) for values in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    [column.cast(kind) for column, kind in zip(columns, arrow_types)], names=schema.names
                )

    arrow_types = _arrow_types(schema)
    return in_arrow(narrow, run, schema)


def _arrow_types(schema: StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(field.dataType) for field in schema.fields]

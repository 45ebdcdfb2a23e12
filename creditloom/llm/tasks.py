"""Arrow batches in, rows out: how operators in Python run inside Spark's own partitions, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that are Python objects at a time; a batch of long texts stays in Arrow's buffers until their turn.
SLICE = 128


def map_rows(df: DataFrame, schema: str, work: Callable[[Iterator[tuple]], Iterable[tuple]]) -> DataFrame:
    """``work`` gets the rows of a partition as tuples, in order, and yields tuples of ``schema``. It streams: neither side is held whole."""
    target = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                yield from zip(*(column.to_pylist() for column in batch.slice(start, SLICE).columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row in work(rows(batches)):
            out.append(row)
            if len(out) == SLICE:
                yield _batch(out, arrow)
                out = []
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(run, target)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, type=field.type) for values, field in zip(zip(*rows), schema)], schema=schema)

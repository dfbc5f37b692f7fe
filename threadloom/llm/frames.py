"""Small helpers between data frames and the Arrow batches of a task."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import RecordBatch
from pyspark.sql import DataFrame

#: Text of one Arrow batch is bounded by rows only, so batches of long texts are cut again by bytes in each task.
HELD_BYTES = 32 << 20


def chosen(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names; other columns, whatever they are called, go."""
    return df.select(*[df[column].alias(name) for name, column in columns.items()])


def batch(schema: pa.Schema, *columns) -> RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)]
    arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema, strict=True)]
    return RecordBatch.from_arrays(arrays, schema=schema)

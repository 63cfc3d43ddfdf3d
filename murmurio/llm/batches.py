"""Arrow batches of bounded size, and groups of consecutive rows in them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once by rows and by bytes, as texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def schema_with(df: DataFrame, columns: str, drop: tuple[str, ...] = ()) -> T.StructType:
    """Schema of a frame without some columns and with more, given as DDL; these replace their namesakes."""
    new = T._parse_datatype_string(columns).fields
    gone = {*drop, *(f.name for f in new)}
    return T.StructType([f for f in df.schema.fields if f.name not in gone] + new)


def extend(batch: pa.RecordBatch, columns: dict[str, pa.Array], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    """A batch with more columns, as ``schema_with`` says."""
    names = [n for n in batch.schema.names if n not in drop and n not in columns]
    return pa.RecordBatch.from_arrays(
        [batch.column(n) for n in names] + list(columns.values()), names=names + list(columns))


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, dict[str, list]]]:
    """Runs of rows that share a key, as lists of column values; rows must be sorted by the key."""
    held, at = None, None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        keys = columns[key]
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            part = {n: v[start:i] for n, v in columns.items()}
            if held is not None and keys[start] == at:
                for n, v in part.items():
                    held[n].extend(v)
            else:
                if held is not None:
                    yield at, held
                held, at = part, keys[start]
            start = i
    if held is not None:
        yield at, held

"""Batches of rows through Arrow: the one place where the operators leave the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

ROWS_PER_CALL = 512


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """``make()`` is called once per task and returns ``fn(columns) -> columns``, where
    ``columns`` maps a name to an Arrow array in, and to a list, array or Arrow array out.
    ``fn`` sees at most ROWS_PER_CALL rows at a time, so its memory does not depend on the
    size of a partition.  Integers stay Arrow integers: nulls never turn them to floats."""
    struct: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_CALL):
                part = whole.slice(start, ROWS_PER_CALL)
                out = fn({n: part.column(i) for i, n in enumerate(part.schema.names)})
                yield to_batch(out, arrow)

    return df.mapInArrow(run, struct)


def keep_rows(df: DataFrame, make: Callable[[], Callable]) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which ``make()``'s ``fn(columns)`` is true: each row
    is judged where it is, so nothing is shuffled and rows need no name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_CALL):
                part = whole.slice(start, ROWS_PER_CALL)
                yield part.filter(pa.array(fn({n: part.column(i) for i, n in enumerate(part.schema.names)}), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def to_batch(out: dict, arrow: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in arrow:
        v = out[field.name]
        if isinstance(v, (pa.Array, pa.ChunkedArray)):
            arrays.append(v.cast(field.type))
        else:
            arrays.append(pa.array(v, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def lists(values: np.ndarray, ends: np.ndarray, type_=pa.int64()) -> pa.ListArray:
    """A list column from its flat values and the end offset of each row."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=type_))

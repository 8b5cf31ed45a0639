"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snowlit.checkpoints import work_path, write_step

# Text bytes handed to a function at once; a longer single row still goes whole.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut by rows so that strings and binaries of a piece stay near ``limit``."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply a function of columns to columns over bounded slices of Arrow batches.

    ``make`` runs once per task and gives ``fn(columns: dict[str, list]) -> dict``
    whose lists (or Arrow arrays) need not be as long as the input.
    """
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for piece in slices(batch, limit):
                got = fn({n: piece.column(i).to_pylist() for i, n in enumerate(names)})
                arrays = [
                    v if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                    for f, v in ((f, got[f.name]) for f in arrow)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, fields)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    return write_step(df, work_path(df.sparkSession, name))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()

"""Vectors as rows of integers: each component x becomes floor(256 * x), packed little-endian."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 256.0


def whole(vector: F.Column) -> F.Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def unpack(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), "<i4") for v in column]


def packed(df: DataFrame, vec_col: str, limit: int) -> DataFrame:
    """``df`` with ``vec_col`` replaced by the binary of its integers; a component past ``limit`` raises."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == vec_col else f for f in df.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vec_col)
            lists = batch.column(at)
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))))
            values = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(values) and np.abs(values).max() > limit:
                raise OverflowError(f"a component beyond {limit / SCALE:g} would take results past a long")
            data = values.astype("<i4").tobytes()
            rows = pa.array([data[4 * i : 4 * j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
            columns = [rows if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return df.mapInArrow(run, schema)

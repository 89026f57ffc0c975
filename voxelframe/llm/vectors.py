"""Vectors of an embedding table as flat bytes for the Python workers."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(col: Column) -> Column:
    """Whether a vector takes part: not null or empty, no null or non-finite
    component, not all zeros."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(col.isNotNull() & ~bad & F.exists(col, lambda x: x != 0), F.lit(False))


def component_type(table: DataFrame, vector: str) -> str:
    """NumPy type that holds the components exactly: floats stay four bytes."""
    return "<f4" if table.schema[vector].dataType.elementType.typeName() == "float" else "<f8"


def _flatten(batches, kind: str):
    import numpy as np
    import pyarrow as pa
    for b in batches:
        vecs = [np.asarray(v.values.to_numpy(zero_copy_only=False), kind).tobytes()
                for v in b.column(b.num_columns - 1)]
        cols = [b.column(i) for i in range(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(vecs, pa.binary())], names=[*b.schema.names[:-1], "vec"])


def flatten(rows: DataFrame, vector: str, keys: dict[str, str]) -> DataFrame:
    """The rows with a usable vector as ``keys`` (name -> type) and ``vec``,
    the components as little-endian ``component_type`` numbers."""
    kind = component_type(rows, vector)
    types = ", ".join(f"{k} {t}" for k, t in keys.items())
    vec = F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>")
    return (rows.filter(usable(F.col(vector)))
            .select(*[F.col(k).cast(t) for k, t in keys.items()], vec.alias("vec"))
            .mapInArrow(partial(_flatten, kind=kind), f"{types}, vec binary"))


def matrix(column, kind: str):
    """A column of equally long ``vec`` values -> rows of doubles."""
    import numpy as np
    data = [v.as_py() for v in column]
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)


def unit(x):
    """Rows scaled to length one; scaled by the largest component first so
    that squares neither overflow nor vanish."""
    import numpy as np
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))

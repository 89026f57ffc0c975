"""Access to the driver's parquet tables (one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# largest result written into a plan as literals: rows, and values (array
# elements included); analysing a plan grows with its literal expressions
INLINE_ROWS = 256
INLINE_CELLS = 4096


def small_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A bounded driver-side result (statistics, scores, fitted weights) as
    a DataFrame.  Up to ``INLINE_ROWS`` rows and ``INLINE_CELLS`` values
    the rows are literals in the plan, so reading them runs in the JVM
    without starting Python workers; larger tables are shipped as data,
    keeping plans small."""
    from pyspark.sql import functions as F
    st = spark.createDataFrame([], schema).schema      # parses the DDL; no job

    def size(v):
        return len(v) if isinstance(v, (list, tuple)) else 1
    cells = sum(size(v) for r in rows for v in r)
    if not rows or len(rows) > INLINE_ROWS or cells > INLINE_CELLS:
        return spark.createDataFrame(rows, st)

    def lit(v, dt):
        if hasattr(v, "item") and not isinstance(v, (list, tuple)):
            v = v.item()                                  # NumPy scalar
        if isinstance(v, (list, tuple)):
            v = [x.item() if hasattr(x, "item") else x for x in v]
        return F.lit(v).cast(dt)
    structs = [F.struct(*[lit(v, f.dataType).alias(f.name) for v, f in zip(r, st.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name) for f in st.fields])

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.session import checkpoint_dir, ship_package

# rows of a Python batch; texts may be long, so batches stay far below the default
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators: whole texts travel to Python in
    small Arrow batches, and the package is importable on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    ship_package(spark)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: computed once, lineage cut, and a lost executor costs a re-read.
    The files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_text(col):
    """CRC-32 of a value's text, unsigned (null: that of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def group_slices(batches, key: int = 0):
    """Arrow batches sorted by an integer column -> lists of NumPy columns
    that hold whole groups.  The rows of the last, maybe unfinished group are
    carried to the next batch, so memory is one batch and one group."""
    import numpy as np
    import pyarrow as pa
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if held is not None:
            t = pa.concat_tables([held, t])
        k = t.column(key).to_numpy()
        if not len(k):
            held = t
            continue
        cut = int(np.searchsorted(k, k[-1]))
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held

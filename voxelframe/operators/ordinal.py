"""Ordinals: the implicit row order of a region table made explicit.

A region table has one row per time point and no time column, so every
downstream operator needs ``t`` = position of the row inside its scan.
``add_ordinal`` numbers rows per key; with ``split_by`` (a column that is
monotone in the sort order, e.g. the day of a timestamp) the numbering runs
inside (key, split) sub-groups and is shifted by the row counts of earlier
splits, so a key that holds a large share of all rows is spread over many
tasks instead of one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def add_ordinal(df: DataFrame, keys: Sequence[str], order_by: Sequence, name: str = "t",
                split_by: Column | None = None) -> DataFrame:
    """Add a 0-based ``bigint`` position of each row within ``keys``.

    ``order_by`` must be a total order inside a key (add a unique id as the
    last tie-breaker), otherwise positions are not reproducible.
    """
    order = _cols(order_by)
    if split_by is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))

    d = df.withColumn("_split", split_by)
    # rows per (key, split): tiny compared with the data, partial-aggregated
    counts = d.groupBy(*keys, "_split").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_split",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "_split").orderBy(*order)
    from voxelframe.operators.joins import broadcast_if_small
    # the offsets table (keys x splits) is computed once into the checkpoint
    # folder (its size check and the join read that copy, so the source is
    # not aggregated twice) and broadcast only when proven small; the hint
    # also keeps the planner from broadcasting the data side
    # dealt out by (key, split): a partitioning by the key alone would put a
    # hot key back into one task
    return (d.repartition(*keys, "_split").join(broadcast_if_small(offsets), [*keys, "_split"])
             .withColumn(name, (F.row_number().over(w) - 1 + F.col("_off")).cast("bigint"))
             .drop("_split", "_off"))


def day_split(ts_col: str) -> Column:
    """Whole days since the epoch; monotone in ``ts_col``."""
    return F.datediff(F.to_date(F.col(ts_col)), F.lit("1970-01-01").cast("date"))


def numeric_split(c: str, width: int) -> Column:
    """Fixed-width buckets of a numeric ordering column; monotone in ``c``."""
    return F.floor(F.col(c) / F.lit(width))


def prefix_sum(df: DataFrame, keys: Sequence[str], order_by: str, value: Column, name: str, width: int = 65_536) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of each key in the order
    of the integer column ``order_by``.  Sums run inside ranges of ``width``
    order values and are shifted by the ranges before, so a hot key is spread
    over its ranges."""
    d = df.withColumn("_v", value).withColumn("_range", numeric_split(order_by, width))
    ranges = d.groupBy(*keys, "_range").agg(F.sum("_v").alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*keys, "_range", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_range").orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    return (d.repartition(*keys, "_range").withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0))).join(ranges, [*keys, "_range"])
             .withColumn(name, F.col("_in") + F.col("_off")).drop("_v", "_range", "_in", "_off"))


def add_time_ordinal(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                     name: str = "t") -> DataFrame:
    """Add the position of each row within its key by (ts, tiebreak...).

    Rows are range-partitioned by (keys, ts, tiebreak): Spark cuts at sampled
    quantiles, so partitions are even whatever the key sizes, bursts or equal
    timestamps.  The sorted rows are written once as Parquet with their place
    in the partition; a run of a key in a partition starts where the key's
    earlier runs end (one small row per run).  One shuffle of the data, no
    window over it, and later readers share the written rows."""
    import uuid

    from voxelframe.operators.joins import broadcast_if_small
    from voxelframe.session import table_path
    spark = df.sparkSession
    keys, order = list(keys), [*keys, ts_col, *tiebreak]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
           .withColumn("_at", F.monotonically_increasing_id()))
    path = table_path(spark, f"ordinal_{uuid.uuid4().hex}")
    d.write.parquet(path)
    d = spark.read.schema(d.schema).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    runs = d.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    return (d.join(broadcast_if_small(runs), [*keys, "_part"])
             .withColumn(name, (F.col("_at") + F.col("_off")).cast("bigint")).drop("_at", "_part", "_off"))

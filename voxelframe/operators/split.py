"""Train/test splits of region tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.functions.numeric import DRAW_BITS, draw


def sequential_split(df: DataFrame, keys: Sequence[str], t: str, train_frac: float = 0.7,
                     name: str = "split", counts: DataFrame | None = None) -> DataFrame:
    """First ``int(train_frac * n)`` rows of each series (by position among
    its remaining rows) are 'train'.

    Positions count from the series' first ``t`` -- after a rolling mean
    has dropped the incomplete rows, the first kept row is position 0.
    n and the first t per series come from a grouped aggregate (partial
    aggregation) joined back with a size-proven broadcast -- not a window
    over the whole series -- so long series do not land in one task.
    ``counts`` (keys, ``_n`` and optionally ``_t0``) may be given when it is
    cheaper to count the source than ``df``.
    """
    from voxelframe.operators.joins import broadcast_if_small
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_t0"))
    elif "_t0" not in counts.columns:
        counts = counts.withColumn("_t0", F.lit(0).cast("bigint"))
    n = broadcast_if_small(counts)
    cut = F.floor(F.lit(train_frac) * F.col("_n"))
    return (df.join(n, list(keys))
              .withColumn(name, F.when(F.col(t) - F.col("_t0") < cut, F.lit("train")).otherwise(F.lit("test")))
              .drop("_n", "_t0"))


def hash_split(df: DataFrame, id_cols: Sequence[str], test_frac: float = 0.3, seed: int = 0,
               name: str = "split") -> DataFrame:
    """Seeded random split that does not depend on partitioning: the row's
    identity is hashed, so re-running or repartitioning keeps each row's side."""
    h = draw(seed, *[F.col(c) for c in id_cols])
    return df.withColumn(name, F.when(h < F.lit(int(test_frac * (1 << DRAW_BITS))), F.lit("test"))
                                .otherwise(F.lit("train")))


def split_by_key(df: DataFrame, key: str, test_frac: float = 0.3, seed: int = 0,
                 name: str = "split") -> DataFrame:
    """Leak-free variant: whole series (e.g. persons) go to one side."""
    return hash_split(df, [key], test_frac, seed, name)


def exact_size_split(df: DataFrame, id_cols: Sequence[str], test_frac: float = 0.3, seed: int = 0,
                     name: str = "split") -> DataFrame:
    """Seeded split with exactly ceil(test_frac * n) test rows.

    Rows are ranked by a 52-bit draw of their identity (exact in double);
    the draw at rank k is found with the distributed exact-quantile
    search, rows below it are 'test', and only the rows tied at that value
    (a handful) are ordered by a second draw to fill the remaining places.
    Repeated identities may share both draws; they go to one side together.
    """
    import math

    from voxelframe.operators.aggregates import values_at_ranks
    ids = [F.col(c) for c in id_cols]
    d = df.withColumn("_h", draw(seed, *ids).cast("double")).withColumn("_h2", draw(seed + 1, *ids))
    n = d.count()
    k = math.ceil(test_frac * n)
    if k == 0:
        return d.withColumn(name, F.lit("train")).drop("_h", "_h2")
    if k >= n:
        return d.withColumn(name, F.lit("test")).drop("_h", "_h2")
    thr = values_at_ranks(d, {"_h": [k - 1]})[("_h", k - 1)]
    below = d.filter(F.col("_h") < F.lit(thr)).count()
    need = k - below
    tied = (d.filter(F.col("_h") == F.lit(thr)).select("_h2").orderBy("_h2").limit(need).collect())
    cut2 = tied[-1]["_h2"]
    is_test = (F.col("_h") < F.lit(thr)) | ((F.col("_h") == F.lit(thr)) & (F.col("_h2") <= F.lit(cut2)))
    return d.withColumn(name, F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop("_h", "_h2")

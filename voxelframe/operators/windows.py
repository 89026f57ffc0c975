"""Per-series window operators (rolling mean, z-score, de-mean, detrend).

Whole-series statistics (mean, population std, trend) are computed with a
grouped aggregate -- partial aggregation on the map side, so a very long
series costs nothing special -- and joined back on the series key.  Sliding
frames (the 10-row rolling mean) use a window; for very long series the
window is cut into fixed blocks of ``t`` and each block is given the few
rows of the previous block it needs (a halo), so one series can be spread
over many tasks without changing any result.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_mean(df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str],
                 window: int = 10, full_only: bool = True, block: int | None = None,
                 suffix: str = "") -> DataFrame:
    """Trailing mean over the last ``window`` rows of each series.

    ``full_only`` keeps a row only when every column has ``window`` non-null
    values in its frame (a rolling mean followed by dropping incomplete rows).
    ``block``: when set, the series is processed in blocks of ``block``
    positions, each carrying ``window - 1`` halo rows from the block before.
    The block split needs ``t`` to be the contiguous ordinal 0..n-1 (as
    produced by ``add_ordinal``); without ``block`` any ordering column works.
    """
    keys = list(keys)
    lag = window - 1
    if block is None:
        d = df
        part = keys
    else:
        if block <= lag:
            raise ValueError("block must be larger than window - 1")
        b = F.floor(F.col(t) / F.lit(block))
        in_halo = F.pmod(F.col(t), F.lit(block)) >= F.lit(block - lag)
        # a row near the end of a block is also sent to the next block, once
        d = df.withColumn("_blk", F.explode(
            F.when(in_halo, F.array(b, b + 1)).otherwise(F.array(b))))
        part = keys + ["_blk"]
        d = d.repartition(*part)        # not by the key alone, which may be hot
    w = Window.partitionBy(*part).orderBy(t).rowsBetween(-lag, 0)
    out = d.select(
        *[c for c in d.columns if c not in cols and c != "_blk"],
        *[F.avg(c).over(w).alias(c + suffix) for c in cols],
        *[F.count(c).over(w).alias("_n_" + c) for c in cols],
        *(["_blk"] if block is not None else []),
    )
    if block is not None:
        # keep each row only in its home block (drop the halo copies)
        out = out.filter(F.col("_blk") == F.floor(F.col(t) / F.lit(block))).drop("_blk")
    if full_only:
        cond = None
        for c in cols:
            e = F.col("_n_" + c) == F.lit(window)
            cond = e if cond is None else (cond & e)
        out = out.filter(cond)
    return out.drop(*["_n_" + c for c in cols])


def _stat_exprs(cols: Sequence[str], t: str | None) -> list[tuple[str, Column]]:
    aggs = []
    for c in cols:
        aggs += [(f"_mu_{c}", F.avg(c)), (f"_sd_{c}", F.stddev_pop(c))]
        if t is not None:
            aggs += [(f"_cv_{c}", F.covar_pop(F.col(t).cast("double"), F.col(c)))]
    if t is not None:
        aggs += [("_mu_t", F.avg(F.col(t).cast("double"))), ("_var_t", F.var_pop(F.col(t).cast("double")))]
    return aggs


def series_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 t: str | None = None) -> DataFrame:
    """One row per series: mean and population std of each column (plus the
    mean/variance of ``t`` and covariance with ``t`` for detrending)."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in _stat_exprs(cols, t)])


def with_series_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                      t: str | None = None, how: str = "join") -> DataFrame:
    """Attach per-series statistics to every row.

    ``how="join"``: grouped aggregate (partial aggregation, so a series of
    any length is combined by many tasks) joined back; the statistics table
    has one row per series and is broadcast when it is proven small.  The
    input is read twice but never shuffled -- the form for raw, long,
    possibly very unequal series.
    ``how="window"``: window aggregates over ``partitionBy(keys)`` -- one
    exchange and one read, each series in one task.  The form for series
    that are bounded (region tables after voxel aggregation: one row per
    time point).
    """
    if how == "window":
        w = Window.partitionBy(*keys)
        return df.select("*", *[e.over(w).alias(n) for n, e in _stat_exprs(cols, t)])
    from voxelframe.operators.joins import broadcast_if_small
    return df.join(broadcast_if_small(series_stats(df, keys, cols, t)), list(keys))


def _safe_sd(c: Column, min_std: float = 0.0) -> Column:
    # constant series: divide by 1 (leave the centred values, i.e. zeros)
    return F.when(c.isNull() | (c <= F.lit(min_std)), F.lit(1.0)).otherwise(c)


def demean(df: DataFrame, keys: Sequence[str], cols: Sequence[str], how: str = "join") -> DataFrame:
    """x - mean(x) per series."""
    j = with_series_stats(df, keys, cols, how=how)
    return j.select(*[c for c in df.columns if c not in cols],
                    *[(F.col(c) - F.col(f"_mu_{c}")).alias(c) for c in cols])


def zscore(df: DataFrame, keys: Sequence[str], cols: Sequence[str], min_std: float = 0.0,
           how: str = "join") -> DataFrame:
    """(x - mean) / population std per series; std 0 (or at most
    ``min_std``, for series that are constant up to rounding) -> divide by 1."""
    j = with_series_stats(df, keys, cols, how=how)
    return j.select(*[c for c in df.columns if c not in cols],
                    *[((F.col(c) - F.col(f"_mu_{c}")) / _safe_sd(F.col(f"_sd_{c}"), min_std)).alias(c)
                      for c in cols])


def detrend(df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str], how: str = "join") -> DataFrame:
    """Remove the least-squares line in ``t`` from each series."""
    j = with_series_stats(df, keys, cols, t=t, how=how)
    tt = F.col(t).cast("double")

    def slope(c):
        return F.when(F.col("_var_t") > 0, F.col(f"_cv_{c}") / F.col("_var_t")).otherwise(F.lit(0.0))

    return j.select(*[c for c in df.columns if c not in cols],
                    *[(F.col(c) - (F.col(f"_mu_{c}") + slope(c) * (tt - F.col("_mu_t")))).alias(c)
                      for c in cols])
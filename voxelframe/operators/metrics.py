"""Regression metrics as one-pass grouped aggregates.

R² = 1 - SSE / SST with SST = n * var_pop(y); a constant target gives 1
when the fit is exact and 0 otherwise.  ``denominator='prediction'``
reproduces metrics computed with the arguments swapped (SST taken from the
predictions).  Every figure, the count included, is over the rows that have
both values; without any, n is 0, R² is 0 and the errors are null.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _r2(sse: Column, sst: Column) -> Column:
    return (F.when(sst > 0, F.lit(1.0) - sse / sst)
             .when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def metric_columns(y: str, p: str, denominator: str = "target", prefix: str = "") -> list[Column]:
    e = F.col(y) - F.col(p)
    sse = F.sum(e * e)
    both = F.col(y).isNotNull() & F.col(p).isNotNull()
    base = F.when(both, F.col(p) if denominator == "prediction" else F.col(y))
    sst = F.var_pop(base) * F.count(base)
    return [F.count(base).alias(prefix + "n"),
            _r2(sse, sst).alias(prefix + "r2"),
            F.avg(e * e).alias(prefix + "mse"),
            F.avg(F.abs(e)).alias(prefix + "mae")]


def regression_metrics(df: DataFrame, keys: Sequence[str], y: str, p: str,
                       denominator: str = "target") -> DataFrame:
    """n, r2, mse, mae per group (``keys`` may be empty for one row)."""
    return df.groupBy(*keys).agg(*metric_columns(y, p, denominator))


def score_matrix(df: DataFrame, keys: Sequence[str], split: str, y: str, p: str,
                 digits: int = 2) -> DataFrame:
    """Per group: r2 and mae of train and test side by side, rounded half to
    even (``np.round``)."""
    m = regression_metrics(df, [*keys, split], y, p)
    wide = m.groupBy(*keys).pivot(split, ["train", "test"]).agg(
        F.first("r2").alias("r2"), F.first("mae").alias("mae"))
    from voxelframe.functions.numeric import half_even
    return wide.select(*keys, *[half_even(F.col(f"{s}_{m}"), digits).alias(f"{m}_{s}")
                                for m in ("r2", "mae") for s in ("train", "test")])


def thin(history: DataFrame, epoch: str, every: int) -> DataFrame:
    """Keep one epoch in ``every`` (the printed progress lines)."""
    return history.filter(F.col(epoch) % F.lit(every) == 0)


def flag(scores: DataFrame, metric: str, threshold: float) -> DataFrame:
    """Regions whose metric falls below the threshold."""
    return scores.filter(F.col(metric) < F.lit(threshold))

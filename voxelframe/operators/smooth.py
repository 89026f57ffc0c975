"""Neighbourhood (Gaussian) smoothing of voxel values.

Physical forms of the same operator:

* ``smooth_array``: all voxels of one time point sit in one array column;
  smoothing is a per-row higher-order-function expression -- no shuffle.
* ``smooth_long``: long voxel rows; every row sends ``w * value`` to each
  neighbour within the kernel (fan-out = kernel size, bounded), and a
  grouped sum per target voxel divides by the summed weights of the
  neighbours that exist (weights renormalised at the edges);
* ``smooth_volume``: volumes; a kernel that is a product of one line of weights
  per axis takes one pass per axis over numerator and weight, so a voxel is
  sent to 3 (2r + 1) places instead of (2r + 1)^3.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gaussian_kernel(fwhm: float, radius: int) -> list[tuple[int, float]]:
    """(offset, weight) for offsets -radius..radius; sigma = fwhm / sqrt(8 ln 2)."""
    sigma = fwhm / math.sqrt(8.0 * math.log(2.0))
    return [(o, math.exp(-(o * o) / (2.0 * sigma * sigma))) for o in range(-radius, radius + 1)]


def smooth_array(df: DataFrame, vec: str, kernel: Sequence[tuple[int, float]], name: str) -> DataFrame:
    arr = F.col(vec)

    def at(i, o):
        j = i + F.lit(o)
        return F.when((j >= 0) & (j < F.size(arr)), F.element_at(arr, j + 1).cast("double"))

    def one(x, i):
        num = None
        den = None
        for o, w in kernel:
            v = at(i, o)
            t = F.coalesce(v * F.lit(w), F.lit(0.0))
            u = F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
            num = t if num is None else num + t
            den = u if den is None else den + u
        return num / den

    return df.withColumn(name, F.transform(arr, one))


def _smooth(df: DataFrame, keys: Sequence[str], axes: Sequence[str], value: str, kernel, name: str) -> DataFrame:
    """``kernel`` rows are (offset per axis..., weight); every row sends its
    weighted value to the voxels around it, itself (offset 0) included."""
    zero = [tuple(k[:-1]) == (0,) * len(axes) for k in kernel]
    if sum(zero) != 1:
        raise ValueError("the kernel must hold offset zero once")
    ks = F.array(*[F.struct(*[F.lit(o).alias(f"o{i}") for i, o in enumerate(k[:-1])], F.lit(float(k[-1])).alias("w"),
                            F.lit(z).alias("z")) for k, z in zip(kernel, zero)])
    there = F.col(value).isNotNull()
    sent = (df.select(*keys, *axes, F.col(value).alias("_v"), there.alias("_e"), F.explode(ks).alias("k"))
              .select(*keys, *[(F.col(a) - F.col(f"k.o{i}")).alias(a) for i, a in enumerate(axes)],
                      (F.col("k.w") * F.col("_v")).alias("_wv"), F.when(F.col("_e"), F.col("k.w")).alias("_w"),
                      F.col("k.z").alias("_own")))
    # the row sent with offset zero marks a voxel that exists
    agg = sent.groupBy(*keys, *axes).agg(F.sum("_wv").alias("_num"), F.sum("_w").alias("_den"), F.max("_own").alias("_own"))
    return agg.filter("_own").select(*keys, *axes, (F.col("_num") / F.col("_den")).alias(name))


def smooth_long(df: DataFrame, keys: Sequence[str], pos: str, value: str,
                kernel: Sequence[tuple[int, float]], name: str) -> DataFrame:
    """1-D neighbourhood along ``pos`` inside each ``keys`` group.  Positions
    that exist receive a value; contributions come only from existing rows."""
    return _smooth(df, keys, [pos], value, kernel, name)


def gaussian_kernel_3d(fwhm: float, radius: int) -> list[tuple[int, int, int, float]]:
    """(dx, dy, dz, weight) within a cube of ``radius`` voxels: the product of
    one Gaussian per axis."""
    line = gaussian_kernel(fwhm, radius)
    return [(a, b, c, u * v * w) for a, u in line for b, v in line for c, w in line]


def _smooth_by_axis(df: DataFrame, keys: Sequence[str], axes: Sequence[str], value: str, line, name: str) -> DataFrame:
    """One pass per axis along ``line`` (offset, weight): numerator and weight
    are smoothed alike, so their quotient is that of the product kernel.
    Places without a voxel carry sums between passes, as a voxel may reach
    another only by way of them; the sums sent with offset zero in every pass
    mark the places that hold a voxel."""
    if sum(o == 0 for o, _ in line) != 1:
        raise ValueError("the kernel must hold offset zero once")
    there = F.col(value).isNotNull()
    d = df.select(*keys, *axes, F.col(value).cast("double").alias("_num"), F.when(there, F.lit(1.0)).alias("_den"),
                  F.lit(True).alias("_own"))
    ks = F.array(*[F.struct(F.lit(int(o)).alias("o"), F.lit(float(w)).alias("w")) for o, w in line])
    for axis in axes:
        sent = d.select("*", F.explode(ks).alias("k"))
        sent = sent.select(*keys, *[(F.col(a) - F.col("k.o")).alias(a) if a == axis else F.col(a) for a in axes],
                           (F.col("_num") * F.col("k.w")).alias("_num"), (F.col("_den") * F.col("k.w")).alias("_den"),
                           (F.col("_own") & (F.col("k.o") == 0)).alias("_own"))
        d = sent.groupBy(*keys, *axes).agg(F.sum("_num").alias("_num"), F.sum("_den").alias("_den"), F.max("_own").alias("_own"))
    return d.filter("_own").select(*keys, *axes, (F.col("_num") / F.col("_den")).alias(name))


def smooth_volume(df: DataFrame, keys: Sequence[str], value: str, kernel, name: str,
                  axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Neighbourhood smoothing of volumes: voxel rows (keys..., x, y, z,
    value) with weights renormalised where neighbours are missing.  A kernel
    of (offset, weight) rows stands for the product of that line along every
    axis and takes a pass per axis; one of (dx, dy, dz, weight) rows may have
    any shape and is sent out whole."""
    if all(len(k) == 2 for k in kernel):
        return _smooth_by_axis(df, list(keys), list(axes), value, kernel, name)
    return _smooth(df, keys, list(axes), value, kernel, name)

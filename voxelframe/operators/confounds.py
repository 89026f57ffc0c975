"""High-variance confounds: per scan, the top left singular vectors (time
courses) of the most variable voxels.

1. variance of every voxel over time (partial aggregate per scan, voxel);
2. per scan, voxels above the (100 - percentile)-th percentile of those
   variances (exact percentile over one value per voxel);
3. the selected series, detrended (mean and linear trend removed);
4. the Gram matrix of each scan's time x voxel matrix on the scan's own
   smaller side: time x time when it has fewer time points than selected
   voxels, voxel x voxel otherwise.  Products are added one scan at a time
   from Arrow batches and merged by a native sum per cell;
5. eigenvectors per scan.  On the time side they are the confounds; on the
   voxel side every time point's confounds are u_k = x . v_k / s_k.

A task holds one matrix of the smaller side, at most ``MAX_SIDE`` squared.
A scan larger on both sides is cut into tiles, and its singular vectors come
from blocked subspace iteration (``operators.subspace``).  Nothing passes a
scan's series through one task.  Signs of singular vectors are arbitrary;
components beyond the rank of a scan's matrix are null.
"""

from __future__ import annotations

from functools import partial
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators import windows
from voxelframe.operators.aggregates import high_variance_features

MAX_SIDE = 2048


def _gram_cells(batches, keys: list):
    """Rows (keys..., n, x array) sorted by key -> upper cells of the sum of
    x x^T per key; one matrix at a time."""
    now, total = None, None

    def cells():
        iu, ju = np.triu_indices(len(total))
        out = pd.DataFrame({k: [v] * len(iu) for k, v in zip(keys, now)})
        return out.assign(i=iu.astype(np.int32), j=ju.astype(np.int32), s=total[iu, ju])
    for pdf in batches:
        for k, rows in pdf.groupby(keys, sort=False):
            k = k if isinstance(k, tuple) else (k,)
            n = int(rows["n"].iloc[0])
            if (rows["x"].map(len) != n).any():
                raise ValueError(f"scan {k}: a selected voxel has no value at some time point")
            x = np.stack(rows["x"].to_numpy()).astype(np.float64)
            if k != now:
                if now is not None:
                    yield cells()
                now, total = k, np.zeros((n, n))
            total += x.T @ x
    if now is not None:
        yield cells()


def _top_vectors(pdf: pd.DataFrame, keys: list, n_confounds: int, on_time: bool) -> pd.DataFrame:
    """A scan's matrix rows (i, cells of j >= i) -> its eigenvectors; on the
    voxel side divided by the singular value."""
    n = len(pdf)
    c = np.zeros((n, n))
    for i, row in zip(pdf["i"], pdf["row"]):
        c[i, i:] = c[i:, i] = row
    w, vec = np.linalg.eigh(c)
    order = np.argsort(w)[::-1]
    top = max(float(w[order[0]]), 0.0)
    out = {k: [pdf[k].iloc[0]] for k in keys}
    for m in range(n_confounds):
        ok = m < n and w[order[m]] > top * 1e-12 and w[order[m]] > 0
        scale = 1.0 if on_time else np.sqrt(w[order[m]]) if ok else 1.0
        out[f"p{m}"] = [list(vec[:, order[m]] / scale) if ok else None]
    return pd.DataFrame(out)


def high_variance_confounds(voxels: DataFrame, keys: Sequence[str] = ("scan_id",), voxel: str = "voxel_id",
                            t: str = "t", value: str = "value", n_confounds: int = 5,
                            percentile: float = 2.0, detrend: bool = True, max_side: int = MAX_SIDE) -> DataFrame:
    """(keys..., t, c0..c{n-1}) confound time courses per scan."""
    from voxelframe.operators.joins import broadcast_if_small
    from voxelframe.session import materialize
    keys = list(keys)
    sel = broadcast_if_small(high_variance_features(voxels, keys, voxel, value, percentile).select(*keys, voxel))
    v = voxels.join(sel, [*keys, voxel], "left_semi")
    if detrend:
        v = windows.detrend(v, [*keys, voxel], t, [value])
    v = materialize(v.select(*keys, voxel, t, F.col(value).cast("double").alias("_v")))
    sides = v.groupBy(*keys).agg(F.countDistinct(t).alias("n_t"), F.countDistinct(voxel).alias("n_v"))
    form = F.when(F.least("n_t", "n_v") > max_side, "tiles").when(F.col("n_t") < F.col("n_v"), "time").otherwise("voxel")
    sides = materialize(sides.withColumn("form", form))
    forms = [r["form"] for r in sides.select("form").distinct().collect()]
    found = None
    for f in forms or ["voxel"]:
        scans = broadcast_if_small(sides.filter(F.col("form") == f).drop("form"))
        own = v if len(forms) <= 1 else v.join(scans, keys, "left_semi")
        some = (_by_tiles(own, keys, voxel, t, n_confounds) if f == "tiles"
                else _by_gram(own, scans, keys, voxel, t, n_confounds, f == "time"))
        found = some if found is None else found.unionAll(some)
    return found


def _by_gram(v: DataFrame, sides: DataFrame, keys: list, voxel: str, t: str, n_confounds: int, on_time: bool) -> DataFrame:
    """Scans of which one side is small: eigenvectors of that side's matrix."""
    from voxelframe.operators.joins import broadcast_if_small
    from voxelframe.session import materialize
    # a row per voxel holding its series, or per time point holding its voxels
    along, across, size = (t, voxel, "n_t") if on_time else (voxel, t, "n_v")
    rows = (v.groupBy(*keys, across)
             .agg(F.array_sort(F.collect_list(F.struct(F.col(along).alias("i"), F.col("_v").alias("v")))).alias("_s"))
             .select(*keys, across, F.col("_s.v").alias("x")))
    rows = rows.join(sides.select(*keys, F.col(size).cast("int").alias("n")), keys)
    rows = materialize(rows)        # read by the Gram pass and the projection

    kinds = [f"`{k}` {v.schema[k].dataType.simpleString()}" for k in keys]
    cells = (rows.select(*keys, "n", "x").sortWithinPartitions(*keys)
                 .mapInPandas(partial(_gram_cells, keys=keys), ", ".join([*kinds, "i int", "j int", "s double"]))
                 .groupBy(*keys, "i", "j").agg(F.sum("s").alias("s")))
    matrix = cells.groupBy(*keys, "i").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("j", "s"))), lambda c: c["s"]).alias("row"))
    names = [f"p{m}" for m in range(n_confounds)]

    def solve(pdf):
        return _top_vectors(pdf, keys, n_confounds, on_time)
    vectors = matrix.groupBy(*keys).applyInPandas(solve, ", ".join(kinds + [f"{p} array<double>" for p in names]))
    if on_time:
        times = v.groupBy(*keys).agg(F.array_sort(F.collect_set(t)).alias("_t"))
        return (vectors.join(times, keys)
                .select(*keys, F.posexplode("_t").alias("_i", t), *names)
                .select(*keys, t, *[F.when(F.col(p).isNotNull(), F.get(F.col(p), F.col("_i"))).alias(f"c{m}")
                                    for m, p in enumerate(names)]))

    def dot(p):
        return F.aggregate(F.zip_with(p, F.col("x"), lambda a, b: a * b), F.lit(0.0), lambda acc, e: acc + e)
    return (rows.join(broadcast_if_small(vectors), keys, "left")
                .select(*keys, t, *[dot(F.col(p)).alias(f"c{m}") for m, p in enumerate(names)]))


def _by_tiles(v: DataFrame, keys: list, voxel: str, t: str, n_confounds: int) -> DataFrame:
    """Scans that are large on both sides: the time vectors of the voxel x time
    tiles."""
    from pyspark.sql import Window

    from voxelframe.operators import subspace
    from voxelframe.session import materialize

    def numbered(c, name):
        # one small row per time point or voxel of a scan
        order = Window.partitionBy(*keys).orderBy(c)
        return materialize(v.select(*keys, c).distinct().withColumn(name, (F.row_number().over(order) - 1).cast("bigint")))
    times = numbered(t, "_j")
    cells = v.join(times, [*keys, t]).join(numbered(voxel, "_i"), [*keys, voxel])
    found = subspace.leading_vectors(subspace.tiles_of(cells, keys, "_i", "_j", "_v"), keys, n_confounds)
    names, tile = [f"c{m}" for m in range(n_confounds)], subspace.TILE
    kinds = "".join(f"`{k}` {v.schema[k].dataType.simpleString()}, " for k in keys)

    def spread(it):
        for pdf in it:
            for _, r in pdf.iterrows():
                x = np.frombuffer(r["vectors"]).reshape(-1, len(r["lam"]))
                out = {k: [r[k]] * len(x) for k in keys} | {"_j": r["b"] * tile + np.arange(len(x))}
                for m, c in enumerate(names):
                    real = m < len(r["lam"]) and r["lam"][m] > r["lam"][0] * 1e-12 and r["lam"][m] > 0
                    out[c] = x[:, m] if real else [None] * len(x)
                yield pd.DataFrame(out)
    return (found.mapInPandas(spread, kinds + "_j bigint, " + ", ".join(f"{c} double" for c in names))
                 .join(times, [*keys, "_j"]).select(*keys, t, *names))

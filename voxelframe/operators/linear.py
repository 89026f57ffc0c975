"""Covariance / Gram of all regions in one pass, scalers, linear fits for
every target region at once, confound regression.

The leave-one-region-out fan-out (each region predicted from all others)
never re-scans the data per region: one distributed pass produces the
centred Gram matrix of all regions, and every per-target fit is solved from
that d x d matrix on the driver (d = number of regions, e.g. 48).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------- scaler
def fit_scaler(df: DataFrame, cols: Sequence[str]) -> dict:
    """Mean and population std of each column (one aggregate row)."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_scaler(df: DataFrame, stats: dict, prefix: str = "") -> DataFrame:
    """(x - mean) / std with the given statistics; std 0 -> 1."""
    out = df
    for c, (m, s) in stats.items():
        s = 1.0 if (s is None or s == 0) else s
        out = out.withColumn(prefix + c, (F.col(c) - F.lit(m)) / F.lit(s))
    return out


# ---------------------------------------------------------------- covariance
def covariance_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population covariance and correlation of every pair i < j, long form,
    from one aggregate (Spark's numerically stable co-moment updates)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.struct(F.covar_pop(a, b).alias("cov"), F.corr(a, b).alias("corr")).alias(f"p{k}")
                   for k, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("ci"), F.lit(b).alias("cj"), F.col(f"p{k}.cov").alias("cov"),
                 F.col(f"p{k}.corr").alias("corr")) for k, (a, b) in enumerate(pairs)])).alias("p")
    ).select("p.*")


def _flat_vectors(batch, dim: int) -> np.ndarray:
    """The rows of an Arrow array column as one matrix, without a Python list
    per row; every vector must have ``dim`` non-null components."""
    col = batch.column(0)
    lengths = np.diff(col.offsets.to_numpy())
    if col.null_count or (lengths != dim).any() or col.flatten().null_count:
        raise ValueError(f"vectors must have {dim} non-null components")
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), dim)


def gram(df: DataFrame, vec: str, dim: int, center: np.ndarray | None = None) -> tuple[int, np.ndarray]:
    """n and the (centred) d x d cross-product matrix of a vector column.
    Only the d x d result reaches the driver."""
    n, mean, m2 = centred_gram(df, vec, dim, np.zeros(dim) if center is None else center)
    d = mean - (0 if center is None else np.asarray(center, dtype=np.float64))
    return n, m2 + n * np.outer(d, d)


def centred_gram(df: DataFrame, vec: str, dim: int, shift: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the mean and the centred d x d cross products of a vector column
    in one pass.

    Each Arrow batch adds ``(X - K).T @ (X - K)`` and the column sums of
    ``X - K`` for a fixed shift ``K`` (any row of the data, e.g. the first);
    then ``M2 = G - n d d^T`` with ``d`` the mean of ``X - K``.  With ``K``
    a sample of the data, ``X - K`` is on the scale of the spread rather
    than the mean, so the subtraction loses no precision to speak of.
    """
    k = np.asarray(shift, dtype=np.float64)
    iu, ju = np.triu_indices(dim)

    def partial(batches):
        g = np.zeros((dim, dim))
        sm = np.zeros(dim)
        n = 0
        for b in batches:
            if b.num_rows:
                x = _flat_vectors(b, dim) - k
                g += x.T @ x
                sm += x.sum(axis=0)
                n += len(x)
        if n:
            # the sums travel as row i = -1
            yield pa.RecordBatch.from_pydict({
                "i": np.concatenate([iu, np.full(dim, -1)]).astype(np.int32),
                "j": np.concatenate([ju, np.arange(dim)]).astype(np.int32),
                "s": np.concatenate([g[iu, ju], sm]), "n": np.full(len(iu) + dim, n, dtype=np.int64)})

    agg = (df.select(vec).mapInArrow(partial, "i int, j int, s double, n long")
             .groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
    g = np.zeros((dim, dim))
    sm = np.zeros(dim)
    n = 0
    for r in agg:
        if r["i"] < 0:
            sm[r["j"]] = r["s"]
        else:
            g[r["i"], r["j"]] = r["s"]
            g[r["j"], r["i"]] = r["s"]
        n = r["n"]
    d = sm / max(n, 1)
    return n, k + d, g - n * np.outer(d, d)


# up to this many columns a grouped Gram is a native aggregate; wider
# matrices are summed from per-batch BLAS products in Arrow batches
NATIVE_GRAM_MAX_DIM = 16
# merged cells of all groups that reach the driver
MAX_GRAM_BYTES = 64 << 20


def gram_by(df: DataFrame, key: str, cols: Sequence[str], max_groups: int = 10_000) -> dict:
    """{key value: (n, uncentred d x d cross products of ``cols``)} for every
    group in one pass, over the complete rows: a row with a null in any of
    ``cols`` is left out of ``n`` and of every product, whatever the width.
    More than ``max_groups`` groups, or groups of more than ``MAX_GRAM_BYTES``
    together, raise.

    Up to ``NATIVE_GRAM_MAX_DIM`` columns the products are sums in one native
    aggregate; wider, each partition adds ``X.T @ X`` per group and only the
    d x d matrices are summed across the cluster."""
    cols = list(cols)
    dim = len(cols)
    iu, ju = np.triu_indices(dim)
    cells = len(iu)
    whole = df.select(F.col(key).alias("k"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    whole = whole.dropna(subset=[f"x{i}" for i in range(dim)])
    if dim <= NATIVE_GRAM_MAX_DIM:
        x = [F.col(f"x{i}") for i in range(dim)]
        sums = whole.groupBy("k").agg(F.count(F.lit(1)).alias("n"),
                                      F.array(*[F.sum(x[i] * x[j]) for i, j in zip(iu, ju)]).alias("s"))
    else:
        def partial(batches):
            acc: dict = {}
            for pdf in batches:
                x_all = pdf.iloc[:, 1:].to_numpy(dtype=np.float64)
                for k, at in pdf.groupby("k", dropna=False).indices.items():
                    a = acc.setdefault(None if pd.isna(k) else k, [np.zeros((dim, dim)), 0])
                    a[0] += x_all[at].T @ x_all[at]
                    a[1] += len(at)
            if acc:
                yield pd.DataFrame([(k, n, i, g[iu[i], ju[i]]) for k, (g, n) in acc.items() for i in range(cells)],
                                   columns=["k", "n", "cell", "s"])
        ktype = df.schema[key].dataType.simpleString()
        parts = whole.mapInPandas(partial, f"k {ktype}, n long, cell int, s double")
        by_cell = parts.groupBy("k", "cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        # d(d+1)/2 merged cells per group
        sums = by_cell.groupBy("k").agg(F.max("n").alias("n"), F.transform(
            F.array_sort(F.collect_list(F.struct("cell", "s"))), lambda c: c["s"]).alias("s"))
    # the driver takes a bounded number of groups and of bytes
    most = min(max_groups, max(1, MAX_GRAM_BYTES // (8 * cells)))
    rows = sums.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} groups of {cells} cells for a grouped Gram")
    out = {}
    for r in rows:
        g = np.zeros((dim, dim))
        g[iu, ju] = g[ju, iu] = r["s"]
        out[r["k"]] = (r["n"], g)
    return out


def covariance_from_gram(n: int, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cov = g / n
    sd = np.sqrt(np.diag(cov))
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = cov / np.outer(sd, sd)
    return cov, corr


# ---------------------------------------------------------------- fits
def lasso_all_targets(cov: np.ndarray, alpha: float, max_iter: int = 1000,
                      tol: float = 1e-10) -> np.ndarray:
    """Lasso coefficients for every target region from the others.

    Objective per target k: (1/2n)||y_k - X_{-k} b||² + alpha ||b||_1 on
    centred data, solved by coordinate descent on the covariance matrix.
    Returns W (d x d) with W[k, j] the weight of region j for target k,
    W[k, k] = 0.
    """
    d = cov.shape[0]
    w = np.zeros((d, d))
    for k in range(d):
        idx = [j for j in range(d) if j != k]
        a = cov[np.ix_(idx, idx)]
        c = cov[idx, k]
        b = np.zeros(d - 1)
        for _ in range(max_iter):
            delta = 0.0
            for j in range(d - 1):
                if a[j, j] == 0:
                    continue
                r = c[j] - a[j] @ b + a[j, j] * b[j]
                new = np.sign(r) * max(abs(r) - alpha, 0.0) / a[j, j]
                delta = max(delta, abs(new - b[j]))
                b[j] = new
            if delta < tol:
                break
        w[k, idx] = b
    return w


def ols_all_targets(cov: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    """Least squares (optionally ridge) weights of every target from the others."""
    d = cov.shape[0]
    w = np.zeros((d, d))
    for k in range(d):
        idx = [j for j in range(d) if j != k]
        a = cov[np.ix_(idx, idx)] + ridge * np.eye(d - 1)
        w[k, idx] = np.linalg.lstsq(a, cov[idx, k], rcond=None)[0]
    return w


def predict_all_targets(df: DataFrame, cols: Sequence[str], means: np.ndarray, w: np.ndarray,
                        prefix: str = "p_") -> DataFrame:
    """Prediction columns for every target: mean_k + sum_j w[k,j] (x_j - mean_j).
    Plain column arithmetic (JVM, codegen)."""
    cols = list(cols)
    out = []
    for k, ck in enumerate(cols):
        e = F.lit(float(means[k]))
        for j, cj in enumerate(cols):
            if w[k, j] != 0.0:
                e = e + F.lit(float(w[k, j])) * (F.col(cj) - F.lit(float(means[j])))
        out.append(e.alias(prefix + ck))
    return df.select("*", *out)


# ---------------------------------------------------------------- confounds
def confound_residuals(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                       confounds: Sequence[str]) -> DataFrame:
    """Residual of each region on the confounds (with intercept), per scan.

    Each region is fitted over its own complete rows, those where the region
    and all confounds exist; other rows have a null residual.  Values are
    centred by their means over the scan first.  Per scan and region the
    sums of confound products are added up from Arrow batches (one matrix
    product for all regions) and merged by a native aggregate; the small
    normal equations of many scans are solved together, and the residual is
    a projection after the coefficients are joined back.  No task holds a
    scan's series.
    """
    from voxelframe.operators.joins import broadcast_if_small
    keys, cols, confounds = list(keys), list(cols), list(confounds)
    q, m = len(confounds) + 1, len(cols)
    iu, ju = np.triu_indices(q)
    width = len(iu) + q
    means = broadcast_if_small(df.groupBy(*keys).agg(
        *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"_m{i}") for i, c in enumerate([*confounds, *cols])]))
    d = df.join(means, keys)
    centred = [(F.col(c) - F.col(f"_m{i}")).cast("double").alias(f"_x{i}") for i, c in enumerate([*confounds, *cols])]
    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def partial(batches):
        for pdf in batches:
            x = pdf.iloc[:, len(keys):].to_numpy(dtype=np.float64)
            z = np.column_stack([np.ones(len(x)), x[:, :q - 1]])
            sound = ~np.isnan(z).any(axis=1)
            y = x[:, q - 1:]
            there = (~np.isnan(y) & sound[:, None]).astype(np.float64)
            y, z = np.where(there > 0, y, 0.0), np.where(sound[:, None], z, 0.0)
            zz = z[:, iu] * z[:, ju]
            for k, at in pdf.groupby(keys, dropna=False, sort=False).indices.items():
                k = k if isinstance(k, tuple) else (k,)
                out = pd.DataFrame({n: [v] * m for n, v in zip(keys, k)})
                out["region"] = np.arange(m, dtype=np.int32)
                sums = np.hstack([there[at].T @ zz[at], y[at].T @ z[at]])
                for i in range(width):
                    out[f"s{i}"] = sums[:, i]
                yield out

    parts = d.select(*keys, *centred).mapInPandas(
        partial, f"{key_types}, region int, " + ", ".join(f"s{i} double" for i in range(width)))
    sums = parts.groupBy(*keys, "region").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)])

    def solve(batches):
        for pdf in batches:
            s = pdf[[f"s{i}" for i in range(width)]].to_numpy()
            a = np.zeros((len(s), q, q))
            a[:, iu, ju] = a[:, ju, iu] = s[:, :len(iu)]
            # unit diagonal, so confounds of any scale meet one rank tolerance
            scale = np.sqrt(np.einsum("nii->ni", a))
            scale[scale == 0] = 1.0
            inverse = np.linalg.pinv(a / scale[:, :, None] / scale[:, None, :], rcond=1e-12, hermitian=True)
            b = np.einsum("nij,nj->ni", inverse, s[:, len(iu):] / scale) / scale
            yield pdf[[*keys, "region"]].assign(b=list(b))

    solved = sums.mapInPandas(solve, f"{key_types}, region int, b array<double>")
    # one row per scan: the coefficients of its regions in order
    coef = broadcast_if_small(solved.groupBy(*keys).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("region", "b"))), lambda r: r["b"]).alias("_b")))
    j = d.join(coef, keys)
    res = []
    for i, c in enumerate(cols):
        b = F.col("_b")[i]
        fit = F.col(f"_m{q - 1 + i}") + b[0]
        for n, z in enumerate(confounds):
            fit = fit + b[n + 1] * (F.col(z) - F.col(f"_m{n}"))
        res.append((F.col(c) - fit).alias(c))
    return j.select(*[x for x in df.columns if x not in cols], *res)


def single_confound_residual(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | str,
                             confound: str, how: str = "join") -> DataFrame:
    """Closed form for one confound: slope = cov/var, intercept from means,
    all over the rows where both the region value and the confound exist.
    ``how`` as in ``windows.with_series_stats``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    z = F.col(confound)
    aggs = []
    for c in cols:
        y = F.col(c)
        both = y.isNotNull() & z.isNotNull()
        zc, yc = F.when(both, z), F.when(both, y)
        aggs += [(f"_cv_{c}", F.covar_pop(zc, yc)), (f"_vr_{c}", F.var_pop(zc)),
                 (f"_mz_{c}", F.avg(zc)), (f"_my_{c}", F.avg(yc))]
    if how == "window":
        w = Window.partitionBy(*keys)
        j = df.select("*", *[a.over(w).alias(n) for n, a in aggs])
    else:
        from voxelframe.operators.joins import broadcast_if_small
        j = df.join(broadcast_if_small(df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs])), list(keys))
    out = []
    for c in cols:
        slope = F.when(F.col(f"_vr_{c}") > 0, F.col(f"_cv_{c}") / F.col(f"_vr_{c}")).otherwise(F.lit(0.0))
        fit = F.col(f"_my_{c}") + slope * (z - F.col(f"_mz_{c}"))
        out.append((F.col(c) - fit).alias(c))
    return j.select(*[x for x in df.columns if x not in cols], *out)

"""Leading singular vectors of large matrices by blocked subspace iteration.

A matrix X (one per key) lies in tiles of ``TILE`` x ``TILE`` cells.  A block of
q trial vectors over X's columns, cut like the tiles, is multiplied by X'X
again and again: X V is a sum over column tiles, X' (X V) one over row tiles,
so no task holds more than a few tiles and nothing passes the driver but one
row of error bounds.

Plain powers separate close singular values slowly.  Between two
orthonormalisations the block is therefore multiplied by a Chebyshev
polynomial of X'X, which stays small on the unwanted part of the spectrum (up
to the least trial value) and grows fastest beyond it; its degree is chosen
per matrix, so that the largest singular value does not drown the others.
A Rayleigh-Ritz step (matrices of q x q, one per key, in a grouped task) then
gives singular values, vectors and residuals.  It ends when the residuals of
all wanted vectors, over the distance to the next singular value, are below
``tol``.  As with Gram matrices, the squares of singular values are resolved to
1e-15 of the largest: vectors of values below 1e-5 of the largest lose digits.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import partial
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.session import materialize

TILE = 512
# trial vectors beyond twice the wanted ones
EXTRA = 32
MAX_DEGREE = 16
# largest growth of one vector over another between orthonormalisations
MAX_GROWTH = 1e8
MAX_ROUNDS = 60
# partial products added in one grouped call
SUM_FAN = 64


# rows of tiles or blocks that are read, or sent to Python, at once
BATCH = 4
_BATCHED = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")


@contextmanager
def _few_at_once(spark):
    """A row here holds megabytes: batches of the default number of rows would
    not fit a task."""
    before = {k: spark.conf.get(k) for k in _BATCHED}
    for k in _BATCHED:
        spark.conf.set(k, str(BATCH))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def _grouped(fn, **given):
    def run(pdf):
        return fn(pdf, **given)
    return run


def _block(data: bytes, q: int):
    return np.frombuffer(data).reshape(-1, q)


def tiles_of(cells: DataFrame, keys: Sequence[str], row: str, col: str, value: str, tile: int | None = None) -> DataFrame:
    """Cells with dense row and column numbers -> tiles (keys, bi, bj, rows,
    cols, m).  A cell missing inside a matrix raises."""
    keys, tile = list(keys), tile or TILE
    numbered = cells.select(*keys, F.floor(F.col(row) / tile).alias("bi"), F.floor(F.col(col) / tile).alias("bj"),
                            (F.col(row) % tile).cast("int").alias("r"), (F.col(col) % tile).cast("int").alias("c"),
                            F.col(value).cast("double").alias("v"))
    sizes = cells.groupBy(*keys).agg((F.max(row) + 1).alias("n_r"), (F.max(col) + 1).alias("n_c"))

    def dense(pdf: pd.DataFrame) -> pd.DataFrame:
        n_r, n_c = int(pdf["r"].max()) + 1, int(pdf["c"].max()) + 1
        m = np.full((n_r, n_c), np.nan)
        m[pdf["r"].to_numpy(), pdf["c"].to_numpy()] = pdf["v"].to_numpy()
        if np.isnan(m).any() or len(pdf) != m.size:
            raise ValueError(f"matrix {pdf[keys].iloc[0].tolist()}: a cell is missing or repeated")
        head = {k: [pdf[k].iloc[0]] for k in [*keys, "bi", "bj"]}
        return pd.DataFrame({**head, "rows": [n_r], "cols": [n_c], "m": [m.tobytes()]})
    found = numbered.groupBy(*keys, "bi", "bj").applyInPandas(
        dense, _kinds(cells, keys) + "bi bigint, bj bigint, rows int, cols int, m binary")
    # a tile must be as large as its place says, so that a whole missing edge is noticed
    full = found.join(sizes, keys)
    least = F.lit(tile).cast("bigint")
    wanted = ((F.col("rows") == F.least(least, F.col("n_r") - F.col("bi") * tile))
              & (F.col("cols") == F.least(least, F.col("n_c") - F.col("bj") * tile)))
    checked = F.when(wanted, F.col("m")).otherwise(F.raise_error(F.lit("a matrix misses cells at the edge of a tile")).cast("binary"))
    return full.select(*keys, "bi", "bj", "rows", "cols", checked.alias("m"))


def _start(pdf_iter, keys, q):
    for pdf in pdf_iter:
        pdf["v"] = [np.random.default_rng([int(b), 17]).standard_normal((int(n), q)).tobytes()
                    for b, n in zip(pdf["bj"], pdf["cols"])]
        yield pdf[[*keys, "bj", "v"]]


def _multiply(pdf_iter, keys, q, turned):
    out, other = ("bj", "bi") if turned else ("bi", "bj")
    for pdf in pdf_iter:
        pdf["z"] = [((m.T if turned else m) @ _block(v, q)).tobytes() for m, v in
                    ((np.frombuffer(m).reshape(r, -1), v) for m, r, v in zip(pdf["m"], pdf["rows"], pdf["v"]))]
        pdf["part"] = pdf[other] // SUM_FAN
        yield pdf.rename(columns={out: "b"})[[*keys, "b", "part", "z"]]


def _sum(pdf: pd.DataFrame, columns: list) -> pd.DataFrame:
    total = np.sum([np.frombuffer(z) for z in pdf["z"]], axis=0)
    return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in columns}, "z": [total.tobytes()]})


def _product(tiles: DataFrame, blocks: DataFrame, keys: list, q: int, turned: bool, wide: bool) -> DataFrame:
    """X V by row blocks, or X' V by column blocks: (keys, b, z)."""
    at = "bi" if turned else "bj"
    joined = tiles.join(blocks.select(*keys, F.col("b").alias(at), "v"), [*keys, at])
    kinds = _kinds(tiles, keys)
    parts = joined.select(*keys, "bi", "bj", "rows", "m", "v").mapInPandas(
        partial(_multiply, keys=keys, q=q, turned=turned), kinds + "b bigint, part bigint, z binary")
    if wide:
        parts = parts.groupBy(*keys, "b", "part").applyInPandas(
            _grouped(_sum, columns=[*keys, "b", "part"]), kinds + "b bigint, part bigint, z binary")
    return parts.groupBy(*keys, "b").applyInPandas(_grouped(_sum, columns=[*keys, "b"]), kinds + "b bigint, z binary")


def _ritz(pdf: pd.DataFrame, keys: list, q: int, n: int) -> pd.DataFrame:
    """Sums of V'V and V'Y of one matrix -> the rotation of V to Ritz vectors,
    their values, and the polynomial that filters the next trial."""
    c, t = (np.sum([np.frombuffer(x).reshape(q, q) for x in pdf[k]], axis=0) for k in ("c", "t"))
    # columns scaled to length one first: lengths differ by the polynomial's growth
    scale = np.sqrt(np.diag(c))
    scale = np.where(scale > 0, 1 / np.where(scale > 0, scale, 1), 0)
    w, u = np.linalg.eigh(scale[:, None] * c * scale)
    basis = scale[:, None] * u[:, w > 1e-13 * max(w.max(), 1e-300)] / np.sqrt(w[w > 1e-13 * max(w.max(), 1e-300)])
    lam, s = np.linalg.eigh(basis.T @ ((t + t.T) / 2) @ basis)
    lam, s = lam[::-1], (basis @ s)[:, ::-1]
    rotation = np.zeros((q, q))
    rotation[:, :len(lam)] = s
    values = np.zeros(q)
    values[:len(lam)] = np.maximum(lam, 0)
    bound = values[len(lam) - 1] if len(lam) == q else 0.0
    degree, rate = 1, 50.0
    if bound > 0:
        x, last = (max(2 * values[i] / bound - 1, 1 + 1e-12) for i in (0, n - 1))
        degree = int(min(MAX_DEGREE, max(1, math.log(2 * MAX_GROWTH) / math.acosh(x))))
        # by how much the polynomial lifts the last wanted vector over the unwanted ones
        rate = max(0.0, degree * math.acosh(last) - math.log(2))
    return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "rotation": [rotation.tobytes()], "lam": [values.tolist()],
                         "bound": [float(bound)], "degree": [degree], "rate": [rate]})


def _inner(pdf_iter, keys, q):
    for pdf in pdf_iter:
        pairs = [(_block(v, q), _block(y, q)) for v, y in zip(pdf["v"], pdf["y"])]
        pdf["c"], pdf["t"] = [(v.T @ v).tobytes() for v, _ in pairs], [(v.T @ y).tobytes() for v, y in pairs]
        yield pdf[[*keys, "c", "t"]]


def _rotate(pdf_iter, keys, q, n):
    """Blocks of V and X'X V turned to Ritz vectors, their squared residuals,
    and the polynomial's first two terms."""
    for pdf in pdf_iter:
        out = []
        for v, y, r, lam, bound in zip(pdf["v"], pdf["y"], pdf["rotation"], pdf["lam"], pdf["bound"]):
            r, lam = np.frombuffer(r).reshape(q, q), np.asarray(lam)
            v, y = _block(v, q) @ r, _block(y, q) @ r
            away = ((y - v * lam)[:, :n] ** 2).sum(0)
            nxt = y if bound <= 0 else (2 / bound) * y - v
            out.append((v.tobytes(), nxt.tobytes(), away.tolist()))
        pdf["before"], pdf["v"], pdf["away"] = map(list, zip(*out)) if out else ([], [], [])
        pdf["next"] = pdf["gain"] + pdf["rate"]
        yield pdf[[*keys, "b", "before", "v", "away", "lam", "bound", "degree", "gain", "next"]]


def _step(pdf_iter, keys, q, k):
    """One more term of the polynomial where its degree asks for it."""
    for pdf in pdf_iter:
        nxt = []
        for before, v, y, bound, degree in zip(pdf["before"], pdf["v"], pdf["y"], pdf["bound"], pdf["degree"]):
            if k >= degree or bound <= 0:
                nxt.append((before, v))
                continue
            term = 2 * ((2 / bound) * _block(y, q) - _block(v, q)) - _block(before, q)
            nxt.append((v, term.tobytes()))
        pdf["before"], pdf["v"] = map(list, zip(*nxt)) if nxt else ([], [])
        yield pdf[[*keys, "b", "before", "v", "bound", "degree", "gain"]]


def leading_vectors(tiles: DataFrame, keys: Sequence[str], n_vectors: int, tol: float = 1e-8) -> DataFrame:
    """(keys, b, lam, vectors): for every matrix the ``n_vectors`` leading
    right singular vectors (column block b, rows x ``n_vectors`` doubles as
    bytes) and the squares of the singular values; beyond a matrix's rank the
    squares are zero.  Raises if the residuals have not fallen to ``tol``
    after ``MAX_ROUNDS`` rounds."""
    tiles = materialize(tiles)
    with _few_at_once(tiles.sparkSession):
        return materialize(_leading(tiles, list(keys), n_vectors, tol))


def _leading(tiles: DataFrame, keys: list, n_vectors: int, tol: float) -> DataFrame:
    columns = tiles.filter("bi = 0").groupBy(*keys).agg(F.sum("cols").alias("n"))
    least = columns.agg(F.min("n")).first()[0]
    kinds = _kinds(tiles, keys)
    if least is None:
        return tiles.sparkSession.createDataFrame([], kinds + "b bigint, lam array<double>, vectors binary")
    q = int(min(least, 2 * n_vectors + EXTRA))
    n = min(n_vectors, q)
    wide = bool(tiles.agg((F.max("bi") >= SUM_FAN) | (F.max("bj") >= SUM_FAN)).first()[0])
    state = materialize(tiles.filter("bi = 0").select(*keys, "bj", "cols").mapInPandas(
        partial(_start, keys=keys, q=q), kinds + "bj bigint, v binary").withColumnRenamed("bj", "b").withColumn("gain", F.lit(0.0)))

    def applied(blocks):
        z = _product(tiles, blocks, keys, q, False, wide).withColumnRenamed("z", "v")
        y = _product(tiles, z, keys, q, True, wide).withColumnRenamed("z", "y")
        return blocks.join(y, [*keys, "b"])
    for _ in range(MAX_ROUNDS):
        state = materialize(applied(state.select(*keys, "b", "v", "gain")))
        inner = state.mapInPandas(partial(_inner, keys=keys, q=q), kinds + "c binary, t binary")
        ritz = materialize(inner.groupBy(*keys).applyInPandas(
            _grouped(_ritz, keys=keys, q=q, n=n), kinds + "rotation binary, lam array<double>, bound double, degree int, rate double"))
        state = materialize(state.join(ritz, keys).mapInPandas(
            partial(_rotate, keys=keys, q=q, n=n),
            kinds + "b bigint, before binary, v binary, away array<double>, lam array<double>, bound double, degree int, "
            "gain double, next double"))
        # residual over the distance to the nearest other value.  Rounding leaves a part of the largest value in
        # every residual, along the largest vector, where it does no harm; so at that level the lift since the
        # start, by which the unwanted part has shrunk, tells
        away = state.groupBy(*keys).agg(*[F.sqrt(F.sum(F.col("away")[i])).alias(f"e{i}") for i in range(n)],
                                        F.first("lam").alias("lam"), F.first("gain").alias("gain"))
        top = F.col("lam")[0]
        errors = []
        for i in range(n):
            own = F.col("lam")[i]
            gaps = [F.abs(own - F.col("lam")[j]) for j in (i - 1, i + 1) if 0 <= j < q]
            gap = F.least(*gaps) if len(gaps) > 1 else gaps[0] if gaps else own
            shrunk = F.col("gain") >= math.log(1 / tol) + 5
            settled = ((F.col(f"e{i}") <= top * 1e-13) & shrunk) | (own <= top * 1e-12)
            errors.append(F.when(settled, 0.0).otherwise(F.col(f"e{i}") / F.greatest(gap, top * 1e-12)))
        worst, degree = away.agg(F.max(F.greatest(*errors) if n > 1 else errors[0])).first()[0], state.agg(F.max("degree")).first()[0]
        if worst <= tol:
            break
        state = state.withColumn("gain", F.col("next"))
        for k in range(1, degree):
            y = applied(state.select(*keys, "b", "before", "v", "bound", "degree", "gain"))
            state = materialize(y.mapInPandas(partial(_step, keys=keys, q=q, k=k),
                                              kinds + "b bigint, before binary, v binary, bound double, degree int, gain double"))
    else:
        raise RuntimeError(f"singular vectors did not settle: error {worst}")

    def first_ones(pdf_iter):
        for pdf in pdf_iter:
            pdf["vectors"] = [np.ascontiguousarray(_block(v, q)[:, :n]).tobytes() for v in pdf["before"]]
            pdf["lam"] = [list(x[:n]) for x in pdf["lam"]]
            yield pdf[[*keys, "b", "lam", "vectors"]]
    return state.select(*keys, "b", "lam", "before").mapInPandas(first_ones, kinds + "b bigint, lam array<double>, vectors binary")

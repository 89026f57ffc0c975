"""Centroid clustering of integer vectors by a bisector tournament.

A component x becomes the integer floor(1024 x).  Between two centroids i < j
lies the bisector with the integer normal 2 (c_j - c_i) and the threshold
|c_j|^2 - |c_i|^2: a vector whose product with the normal is over the
threshold is nearer to j, and zero, a tie, leaves the smaller number.  Normals
and thresholds of all pairs are computed once a round; a vector's champion
then meets centroids 1 .. k-1 in turn, so k-1 sign tests find its centroid, and
only the distance to that one is computed.

A round is one pass over the staged vectors: every task returns at most k sums
of components and counts, which are added in Spark; the driver holds k
centroids.  All arithmetic is on integers, so the result is the same however
rows are dealt.
"""

from __future__ import annotations

import hashlib
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.llm.common import staged
from voxelframe.llm.vectors import _flatten, component_type
from voxelframe.tables import small_table

UNIT = 1024
# largest component (as integer) for which sums over a task's rows and
# products of vectors stay within 64 bits; beyond it Python integers are used
NARROW = 1 << 24
# rows multiplied at once
TILE = 4096


def sound(col: Column, dims: int) -> Column:
    """Whether a vector takes part: exactly ``dims`` components, none null or
    non-finite."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(col) == dims) & ~bad, F.lit(False))


def to_integers(x, narrow: bool):
    """floor(1024 x) of an array of doubles, exactly: 64-bit integers if
    ``narrow``, else Python integers."""
    import numpy as np
    if narrow:
        return np.floor(x * UNIT).astype(np.int64)
    whole = np.abs(x) >= 2.0 ** 53          # no fraction, and the product might overflow
    flat = [int(v) * UNIT if w else int(np.floor(v * UNIT)) for v, w in zip(x.ravel().tolist(), whole.ravel())]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(x.shape)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids):
        self.centroids = centroids
        square = (centroids * centroids).sum(1)
        self.normal = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.threshold = square[None, :] - square[:, None]

    def nearest(self, x):
        """Centroid number of each row of integers."""
        import numpy as np
        champion = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            met = champion.copy()
            for i in np.unique(met).tolist():
                rows = np.flatnonzero(met == i)
                beyond = (x[rows] * self.normal[i, j]).sum(1) > self.threshold[i, j]
                champion[rows[beyond.astype(bool)]] = j
        return champion

    def distance(self, x, champion):
        """Squared distance of each row to its centroid."""
        away = x - self.centroids[champion]
        return (away * away).sum(1)


def _tiles(batches, dims, kind, narrow):
    import numpy as np
    for b in batches:
        vecs = b.column(b.num_columns - 1)
        for at in range(0, b.num_rows, TILE):
            some = [v.as_py() for v in vecs.slice(at, TILE)]
            x = np.frombuffer(b"".join(some), kind).reshape(len(some), dims).astype(np.float64)
            yield b.column(0).slice(at, TILE), to_integers(x, narrow)


def _totals(batches, centroids, dims, kind, narrow):
    """Per task: (cluster, component, sum); component -1 holds the count."""
    import numpy as np
    import pyarrow as pa
    k, bisectors = len(centroids), Bisectors(centroids)
    counts = [0] * k
    sums = [[0] * dims for _ in range(k)]
    for _, x in _tiles(batches, dims, kind, narrow):
        champion = bisectors.nearest(x)
        for c in np.unique(champion).tolist():
            own = x[champion == c]
            counts[c] += len(own)
            sums[c] = [a + b for a, b in zip(sums[c], own.sum(0).tolist())]
    rows = [(c, p, v) for c in range(k) if counts[c] for p, v in enumerate([counts[c], *sums[c]], -1)]
    # sums travel in 32-bit digits, so adding them cannot overflow
    digits = [(c, p, d, v >> 32 * d & 0xffffffff if d < top else v >> 32 * d)
              for c, p, v in rows for top in [max(1, v.bit_length() // 32)] for d in range(top + 1)]
    cols = list(zip(*digits)) if digits else [[], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                     names=["cluster", "component", "digit", "part"])


def _assigned(batches, centroids, dims, kind, narrow):
    import pyarrow as pa
    bisectors = Bisectors(centroids)
    for ids, x in _tiles(batches, dims, kind, narrow):
        champion = bisectors.nearest(x)
        # a distance beyond 64 bits raises here
        away = pa.array(bisectors.distance(x, champion).tolist(), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array(champion.astype("i4")), away],
                                         names=["vec_id", "cluster", "distance"])


def _moved(rows: DataFrame, centroids, dims, kind, narrow):
    """The centroids after one round; empty clusters keep theirs."""
    import numpy as np
    parts = rows.mapInArrow(partial(_totals, centroids=centroids, dims=dims, kind=kind, narrow=narrow),
                            "cluster int, component int, digit int, part bigint")
    total: dict = {}
    for r in parts.groupBy("cluster", "component", "digit").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("v")).collect():
        at = r["cluster"], r["component"]
        total[at] = total.get(at, 0) + (int(r["v"]) << 32 * r["digit"])
    moved = [[total[c, p] // total[c, -1] for p in range(dims)] if (c, -1) in total else old
             for c, old in enumerate(centroids.tolist())]
    return np.array(moved, centroids.dtype).reshape(len(moved), dims)


def cluster(table: DataFrame, k: int, dims: int, rounds: int, seed: int, id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of every vector that takes part, the final
    centroids).

    Vectors of another length than ``dims`` and those with null or non-finite
    components take no part; null vectors neither.  Centroids start as the
    ``k`` rows with the smallest lowercase-hex SHA-256 of ``seed:id`` (of
    equal ids, the smaller vector by its components; a null id hashes as the
    empty text), all rows if there are fewer.  Repeated rows count as often as
    they occur.  An empty table gives no rows and no centroids.  Distances
    beyond 64 bits raise.  Other columns are not read."""
    import numpy as np
    kind = component_type(table, vector_col)
    vec = F.col(vector_col).cast("array<float>" if kind == "<f4" else "array<double>")
    taken = table.filter(sound(F.col(vector_col), dims)).select(F.col(id_col).cast("bigint").alias("vec_id"), vec.alias("vec"))
    width = F.greatest(F.abs(F.array_max("vec")), F.abs(F.array_min("vec"))).cast("double")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = taken.orderBy(key, "vec").limit(k).collect()
    if not first:
        return table.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), []
    narrow = bool(taken.agg(F.max(width)).first()[0] * UNIT <= NARROW)
    rows = staged(taken.mapInArrow(partial(_flatten, kind=kind), "vec_id bigint, vec binary"), "cluster-vectors")
    centroids = to_integers(np.array([r["vec"] for r in first], np.float64).reshape(len(first), dims), narrow)
    for _ in range(rounds):
        moved = _moved(rows, centroids, dims, kind, narrow)
        if (moved == centroids).all():      # later rounds would change nothing
            break
        centroids = moved
    found = rows.mapInArrow(partial(_assigned, centroids=centroids, dims=dims, kind=kind, narrow=narrow),
                            "vec_id bigint, cluster int, distance bigint")
    return staged(found, "clusters"), [[int(v) for v in c] for c in centroids]


def cluster_report(table: DataFrame, k: int, dims: int, rounds: int, seed: int, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """``cluster`` with the distance summed over the row's cluster and over all
    rows, and the SHA-256 of its centroid's components."""
    found, centroids = cluster(table, k, dims, rounds, seed, id_col, vector_col)
    inertia = {r["cluster"]: int(r["s"]) for r in
               found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(inertia.values())
    named = [(c, inertia[c], total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c in sorted(inertia)]
    known = small_table(table.sparkSession, named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                            "centroid_sha256")

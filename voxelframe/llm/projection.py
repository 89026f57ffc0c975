"""Embedding near-duplicates by sorted projection passes.

Vectors of a label are projected relative to their mean direction, so that
those of a narrow cone spread over all directions; how far apart a pair at the
threshold can then lie follows from each vector's distance to the mean.  Every
vector gets, for each pass, a key of concatenated random hyperplane bits.  A
pass orders all vectors lexicographically by (label, dimension, key) and
compares each with its next ``window`` neighbours; the order is cut into blocks
of consecutive ranks with a halo of ``window`` rows, so no task holds a label.
A pass carries no vectors but a sketch of ``SKETCH`` more bits: neighbours whose
sketches differ in no more bits than a pair at the threshold may are united
over the passes.

Every row measures in every pass how many bits its window takes: the prefix it
shares with the row at the window's edge, and from it the chance to miss a
partner at the threshold.  Rows whose chance over all passes is not yet below
``MISS`` go on, among themselves, with more passes; a label's rest is compared
completely once that costs no more than the next passes would.

Every group found by the passes is then compared completely on its vectors,
tile by tile.  Only these comparisons make links, so none is below the
threshold, and bounded windows cut no partner inside a group.  Equal vectors
are merged first.
"""

from __future__ import annotations

from functools import partial
from math import acos, ceil, log, log2, pi, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxelframe.llm.common import group_slices, shuffle_parts, staged
from voxelframe.llm.graph import connected_components
from voxelframe.llm.simhash import _forest
from voxelframe.llm.vectors import component_type, flatten, matrix, unit, usable

SEED = 7
BITS = 62
# bits of the sketch that judges neighbours
SKETCH = 512
WINDOW = 32
# passes after which all rows that may still miss a partner are compared completely
MAX_PASSES = 1000
BLOCK = 1024
TILE = 512
MISS = 1e-4
# float noise may not decide which pairs reach the exact check
SLACK = 1e-9


def passes_for(n: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair exactly at the threshold is missed with
    probability ``miss``: two such vectors share the key prefix that isolates
    a window among ``n`` rows with probability (1 - angle / pi) ** bits."""
    bits = max(1.0, log2(max(2, n) / window) + 1)
    same = (1 - acos(min(1.0, threshold)) / pi) ** bits
    return max(4, ceil(log(miss) / log(1 - min(same, 0.99))))


def _miss(shared, angle):
    """Logarithms of the probabilities that a pass misses a partner at an angle
    of ``angle``, for rows that share ``shared`` bits with their window's edge
    (-1: the window holds all rows)."""
    import numpy as np
    return np.log(np.maximum(1 - (1 - angle / pi) ** (shared + 1.0), 1e-300))


def _angles(norm, threshold: float):
    """Largest angle, seen from the mean, between a unit vector at distance
    ``norm`` from it and a partner at the threshold (pi: no bound)."""
    import numpy as np
    apart = sqrt(max(0.0, 2 - 2 * min(1.0, threshold))) + 1e-9
    return np.where(norm > apart, np.arcsin(np.minimum(1.0, apart / np.maximum(norm, 1e-300))), pi)


def _shared(x, y):
    """Equal leading bits of keys of ``BITS`` bits."""
    import numpy as np
    differ = x ^ y
    for shift in (1, 2, 4, 8, 16, 32):
        differ |= differ >> np.uint64(shift)
    return BITS - np.bitwise_count(differ).astype(np.int64)


def bits_for(angle, sigmas: float = 5.0):
    """Differing sketch bits up to which two vectors may reach the threshold:
    the expectation at ``angle`` and ``sigmas`` standard deviations."""
    import numpy as np
    p = angle / pi
    return np.ceil(SKETCH * p + sigmas * np.sqrt(SKETCH * p * (1 - p)))


def _group_sums(batches, kind: str):
    """Per task: sums of a label's unit vectors by component."""
    import numpy as np
    import pyarrow as pa
    held: dict = {}

    def rows():
        for (label, dim), (n, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * dim, pa.string()), pa.array([dim] * dim, pa.int32()), pa.array(np.arange(dim, dtype=np.int32)),
                 pa.array(total), pa.array([n] * dim, pa.int64())], names=["label", "dim", "at", "total", "n"])
    for b in batches:
        labels = b.column(0).to_pylist()
        vecs = [np.frombuffer(v.as_py(), kind).astype(np.float64) for v in b.column(1)]
        for label, v in zip(labels, vecs):
            u = unit(v[None])[0]
            was = held.get((label, len(v)))
            held[label, len(v)] = (1, u) if was is None else (was[0] + 1, was[1] + u)
        if sum(dim for _, dim in held) > 1 << 20:
            yield from rows()
            held = {}
    yield from rows()


def _planes(seed: int, first: int, count: int, dim: int):
    """Normals of hyperplanes ``first`` to ``first + count - 1``; every plane
    has a seed of its own, so passes are alike whenever they are made."""
    import numpy as np
    return np.stack([np.random.default_rng([seed, p, dim]).standard_normal(dim) for p in range(first, first + count)], 1)


def _bits(x, planes):
    """Signs of projections, in 64-bit words (bits padded with zeros)."""
    import numpy as np
    bits = x @ planes > 0
    packed = np.packbits(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))), axis=1, bitorder="little")
    return packed.view("<i8")


def _prepared(batches, kind: str, threshold: float):
    """Nodes with their group's mean -> the direction from the mean (floats),
    the angle of partners, and the sketch."""
    import numpy as np
    import pyarrow as pa
    planes: dict = {}
    for b in batches:
        if not b.num_rows:
            continue
        names = b.schema.names
        vecs = [np.frombuffer(v.as_py(), kind).astype(np.float64) for v in b.column(names.index("vec"))]
        means = b.column(names.index("mean"))
        out, angles, sketches = [], np.zeros(len(vecs)), np.zeros((len(vecs), SKETCH // 64), np.int64)
        dims = np.array([len(v) for v in vecs])
        out = [b""] * len(vecs)
        for d in np.unique(dims).tolist():
            if d not in planes:
                planes[d] = _planes(SEED + 1, 0, SKETCH, d)
            at = np.flatnonzero(dims == d)
            x = unit(np.stack([vecs[i] for i in at])) - np.stack([np.asarray(means[int(i)].as_py()) for i in at])
            angles[at] = _angles(np.sqrt((x * x).sum(1)), threshold)
            sketches[at] = _bits(x, planes[d])
            for i, v in zip(at, x.astype("<f4")):
                out[i] = v.tobytes()
        keep = [b.column(names.index(c)) for c in ("node", "label", "dim")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(out, pa.binary()), pa.array(angles),
                                          pa.array(list(sketches), pa.list_(pa.int64()))],
                                         names=["node", "label", "dim", "away", "angle", "sketch"])


def _keys(batches, first: int, passes: int):
    """The keys of passes ``first`` to ``first + passes - 1``, a row each."""
    import numpy as np
    import pyarrow as pa
    weight = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
    planes: dict = {}
    for b in batches:
        if not b.num_rows:
            continue
        names = b.schema.names
        dims, away = b.column(names.index("dim")).to_numpy(), b.column(names.index("away"))
        keys = np.zeros((b.num_rows, passes), np.int64)
        for d in np.unique(dims).tolist():
            if d not in planes:
                planes[d] = _planes(SEED, first * BITS, passes * BITS, d)
            at = np.flatnonzero(dims == d)
            x = np.stack([np.frombuffer(away[int(i)].as_py(), "<f4") for i in at]).astype(np.float64)
            keys[at] = (x @ planes[d] > 0).reshape(len(at), passes, BITS) @ weight
        kept = [c for c in names if c != "away"]
        for p in range(passes):
            yield pa.RecordBatch.from_arrays(
                [*[b.column(names.index(c)) for c in kept], pa.array([p] * b.num_rows, pa.int32()), pa.array(keys[:, p])],
                names=[*kept, "pass", "key"])


def _window_pairs(batches, window: int):
    """Blocks of ranked rows -> a forest of the neighbours whose sketches may
    reach the threshold, and for each row what its window may miss there."""
    import numpy as np
    import pyarrow as pa
    for t in group_slices(batches):
        block, rank, node, part, home, angle, own = (t.column(i).to_numpy() for i in (0, 1, 2, 3, 4, 5, 7))
        if not len(block):
            continue
        sketch = t.column(6).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(block), -1)
        own = own.view(np.uint64)
        most = bits_for(np.minimum(angle, pi / 2))
        hard = angle >= pi
        shared = np.full(len(block), -1)
        left, right = [], []
        for step in range(1, window + 1):
            i = np.arange(max(0, len(block) - step))
            j = i + step
            i = i[(block[i] == block[j]) & (part[i] == part[j]) & (rank[j] - rank[i] <= window) & (home[i] | home[j])]
            if step == window:
                edge = _shared(own[i], own[i + step])
                np.maximum.at(shared, i, edge)
                np.maximum.at(shared, i + step, edge)
            j = i + step
            # the vector farther from the mean bounds the pair's angle best
            fits = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1) <= np.minimum(most[i], most[j])
            i = i[fits & ~(hard[i] & hard[j])]
            left.append(i)
            right.append(i + step)
        low = _forest(np.concatenate(left), np.concatenate(right), len(block))
        at = np.flatnonzero(low != np.arange(len(block)))
        yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[low[at]]), pa.nulls(len(at), pa.float64())],
                                         names=["a", "b", "miss"])
        at = np.flatnonzero(home)
        miss = np.where((shared[at] < 0) & ~hard[at], log(1e-300), _miss(np.maximum(shared[at], 0), angle[at]))
        yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.nulls(len(at), pa.int64()), pa.array(miss)],
                                         names=["a", "b", "miss"])


def _cosines(x, y):
    """Cosines of unit rows, each summed in one fixed order."""
    import numpy as np
    return np.clip((x * y).sum(1), -1, 1)


def _tile_links(batches, threshold: float, kind: str):
    """Tile pairs -> per vector its links there, copies counted by weight, and
    a forest of the links.  Pairs of which both belong to a completely compared
    set count there alone."""
    import numpy as np
    import pyarrow as pa
    for t in group_slices(batches):
        tile, node, side, copies, whole, done = (t.column(i).to_numpy() for i in range(6))
        start = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist(), len(tile)]
        for s, e in zip(start, start[1:]):
            if e == s:
                continue
            x, w, part = unit(matrix(t.column(6).slice(s, e - s), kind)), copies[s:e], side[s:e]
            n = np.zeros(e - s, np.int64)
            one = part[0] == 2
            a = np.arange(e - s) if one else np.flatnonzero(part == 0)
            b = a if one else np.flatnonzero(part == 1)
            sims = x[a] @ x[b].T
            close = sims >= threshold - SLACK
            i, j = np.nonzero(close & (np.abs(sims - threshold) < 2 * SLACK))
            close[i, j] = _cosines(x[a[i]], x[b[j]]) >= threshold      # at the threshold: one fixed order
            if one:
                np.fill_diagonal(close, False)
            if not whole[s]:
                close &= ~(done[s:e][a][:, None] & done[s:e][b][None, :])
            n[a] = close @ w[b]
            if not one:
                n[b] = close.T @ w[a]
            i, j = np.nonzero(close)
            low = _forest(a[i], b[j], e - s)
            yield pa.RecordBatch.from_arrays([pa.array(node[s:e]), pa.array(n), pa.array(node[s:e][low])],
                                             names=["node", "found", "low"])


def _passes(active: DataFrame, first: int, passes: int, window: int) -> DataFrame:
    """Passes over the active rows: (a, b, null) candidate pairs and
    (node, null, miss) per row and pass."""
    keyed = active.select("node", "label", "dim", "angle", "sketch", "away").mapInArrow(
        partial(_keys, first=first, passes=passes),
        "node bigint, label string, dim int, angle double, sketch array<bigint>, pass int, key bigint")
    line = ["pass", "label", "dim", "key", "node"]
    order = (keyed.repartitionByRange(shuffle_parts(active.sparkSession), *line).sortWithinPartitions(*line)
             .select(F.xxhash64("pass", "label", "dim").alias("part"), "node", "angle", "sketch", "key",
                     F.monotonically_increasing_id().alias("at")))
    order = staged(order, "order")
    pid = F.shiftright("at", 33)
    # one row per partition: its first rank
    ahead = order.groupBy(pid.alias("pid")).count().withColumn(
        "first", F.sum("count").over(W.orderBy("pid")) - F.col("count")).select("pid", "first")
    ranked = order.join(F.broadcast(ahead), pid == F.col("pid")).withColumn(
        "rank", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1))
    home = F.floor(F.col("rank") / BLOCK)
    # every home row meets both edges of its window
    at = F.pmod("rank", F.lit(BLOCK))
    halo = F.filter(F.array(F.when(at < window, home - 1), home, F.when(at >= BLOCK - window, home + 1)),
                    lambda b: b.isNotNull())
    blocks = (ranked.select(F.explode(halo).alias("block"), "rank", "node", "part", home.alias("own"), "angle", "sketch", "key")
              .select("block", "rank", "node", "part", (F.col("block") == F.col("own")).alias("home"), "angle", "sketch", "key"))
    return staged(blocks.repartition("block").sortWithinPartitions("block", "rank")
                  .mapInArrow(partial(_window_pairs, window=window), "a bigint, b bigint, miss double"), "window-pairs")


def _candidates(nodes: DataFrame, n: int, threshold: float, window: int, kind: str):
    """(pairs of the passes, the rows that are compared completely with all
    such rows of their group (node, label, dim))."""
    sums = nodes.select("label", "vec").mapInArrow(
        partial(_group_sums, kind=kind), "label string, dim int, at int, total double, n bigint")
    means = (sums.groupBy("label", "dim", "at").agg((F.sum("total") / F.sum("n")).alias("m"))
             .groupBy("label", "dim").agg(F.array_sort(F.collect_list(F.struct("at", "m"))).alias("ms"))
             .select("label", "dim", F.col("ms.m").alias("mean")))
    size = 4 if kind == "<f4" else 8
    ready = nodes.withColumn("dim", (F.length("vec") / size).cast("int")).join(staged(means, "means"), ["label", "dim"])
    active = staged(ready.select("node", "label", "dim", "vec", "mean").mapInArrow(
        partial(_prepared, kind=kind, threshold=threshold),
        "node bigint, label string, dim int, away binary, angle double, sketch array<bigint>"), "directions")
    active = active.withColumn("missed", F.lit(0.0))
    pairs, whole = None, None
    first, passes = 1, passes_for(n, threshold, window)
    while True:
        seen = _passes(active, first, passes, window)
        found = seen.filter("miss is null").select("a", "b")
        pairs = found if pairs is None else pairs.unionAll(found)
        first += passes
        missed = seen.filter("miss is not null").groupBy(F.col("a").alias("node")).agg(F.sum("miss").alias("now"))
        left = active.join(missed, "node").withColumn("missed", F.col("missed") + F.col("now")).drop("now").filter(
            F.col("missed") > log(MISS))
        left = staged(left, "unsure")
        # passes that a row still needs at its rate so far
        need = F.when(F.col("missed") < -1e-9, F.ceil(F.lit(log(MISS)) / F.col("missed") * (first - 1) - (first - 1)))
        bounded = F.col("angle") < pi
        groups = left.filter(bounded).groupBy("label", "dim").agg(
            F.count("*").alias("m"), F.percentile_approx(F.coalesce(need, F.lit(MAX_PASSES)), 0.9, 100).alias("need"))
        # m^2 / 2 pairs of a complete comparison against m window of a pass; the
        # passes go on somewhat longer, as they need no pairs of vectors
        over = (F.col("m") <= window * F.col("need") / 2) | F.lit(first > MAX_PASSES)
        groups = staged(groups.withColumn("over", over), "unsure-groups")
        # rows so near to the mean that nothing bounds a partner's direction are compared completely at once
        judged = left.join(groups.select("label", "dim", "over"), ["label", "dim"], "left")
        rest = ~F.col("over") & bounded
        done = judged.filter(~F.coalesce(rest, F.lit(False))).select("node", "label", "dim")
        whole = done if whole is None else whole.unionAll(done)
        most = groups.filter(~F.col("over")).agg(F.max("need")).first()[0]
        if most is None:
            return pairs, whole
        active = judged.filter(rest).drop("over")
        passes = min(2 * passes, max(1, int(most)))


def near_duplicates(table: DataFrame, threshold: float = 0.98, window: int = WINDOW,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    name_seed: int = 0) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of one label (and one length) link at a cosine of ``threshold`` or
    more.  n_links counts the other rows linked directly, component_id is the
    smallest id reachable and kept marks the row whose id it is.  Rows with a
    null label, or a vector that is null, empty, zero or holds null or
    non-finite components, have no links and are their own component (a null
    id stays null, kept false).  Equal vectors of a label are linked; of
    repeated rows each counts.  Other columns are not read.  ``name_seed``
    enters the hashes that name vectors; two that share one raise."""
    spark = table.sparkSession
    kind = component_type(table, vector_col)
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                        F.col(vector_col).alias("embedding"))
    sound = staged(flatten(rows.filter("label is not null"), "embedding", {"vec_id": "bigint", "label": "string"}),
                   "vectors")
    # equal (label, vector) rows are one node, named by a hash checked for clashes below
    same = sound.groupBy("label", "vec").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    name = F.xxhash64("label", "vec", F.lit(name_seed))
    nodes = staged(same.withColumn("node", name), "nodes")
    n, names = nodes.agg(F.count("*"), F.countDistinct("node")).first()
    if n != names:          # some two of all vectors, about one table in ten at 10**9 of them
        raise RuntimeError("two vectors share a hash: pass another name_seed")
    pairs, whole = _candidates(nodes, n, threshold, window, kind)
    group = staged(connected_components(pairs), "candidate-groups")
    whole = staged(whole.select(F.xxhash64("label", "dim").alias("of"), "node"), "complete-sets")

    # all pairs inside each candidate group and each complete set, tile by tile
    sets = group.select(F.col("component").alias("of"), "node", F.lit(False).alias("whole")).unionAll(
        whole.select("of", "node", F.lit(True)))
    sets = sets.join(whole.select("node", F.lit(True).alias("done")), "node", "left")
    members = nodes.join(sets, "node").select("of", "whole", F.coalesce("done", F.lit(False)).alias("done"), "node", "copies", "vec")
    size = sets.groupBy("of", "whole").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("tiles")).cast("int")
    lo, hi = F.least("tile", "other"), F.greatest("tile", "other")
    side = F.when(F.col("tile") == F.col("other"), 2).otherwise((F.col("tile") > F.col("other")).cast("int"))
    tiles = (members.join(size, ["of", "whole"]).withColumn("tile", tile)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select(F.xxhash64("of", "whole", lo, hi).alias("pair"), "node", side.alias("side"), "copies", "whole", "done", "vec"))
    linked = staged(tiles.repartition("pair").sortWithinPartitions("pair")
                    .mapInArrow(partial(_tile_links, threshold=threshold, kind=kind),
                                "node bigint, found bigint, low bigint"), "links")
    found = linked.groupBy("node").agg(F.sum("found").alias("found"))
    comp = connected_components(linked.select("node", "low"))
    known = (nodes.select("node", "low", "copies").join(comp, "node", "left").join(found, "node", "left")
             .select("node", "low", "copies", F.coalesce("component", "node").alias("comp"),
                     F.coalesce("found", F.lit(0)).alias("found")))
    known = staged(known, "vector-links")
    best = known.groupBy("comp").agg(F.min("low").alias("component_id"))
    label = known.join(best, "comp").select("node", (F.col("found") + F.col("copies") - 1).alias("n_links"),
                                            "component_id")
    named = sound.select("vec_id", name.alias("node"))
    linked = named.join(label, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("label").isNull() | ~usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

"""Aggregations: region means, distinct lists, describe, exact quantiles,
high-variance feature selection."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.operators.joins import sized_broadcast
from voxelframe.tables import small_table


def region_means(voxels: DataFrame, atlas: DataFrame, keys: Sequence[str], label_col: str,
                 value_col: str, labels: Sequence, names: Sequence[str] | None = None,
                 background=0) -> DataFrame:
    """Mean signal of every labelled region per (scan, time point), wide.

    ``voxels`` (scan, voxel, t, value) is joined to the broadcast atlas
    (voxel -> label, background removed) and reduced by ONE grouped
    aggregate holding a conditional mean per label from the fixed ``labels``
    list -- partial aggregation combines the voxels of a (scan, t) map-side,
    so only one small row per (scan, t) and task is shuffled.  (A pivot
    would add a second aggregation and exchange.)  Output columns are
    ``names`` (default x0..x{n-1}, positional naming).
    """
    names = list(names or [f"x{i}" for i in range(len(labels))])
    at = atlas.filter(F.col(label_col) != F.lit(background)) if background is not None else atlas
    j = voxels.join(sized_broadcast(at), [c for c in atlas.columns if c in voxels.columns])
    lab = F.col(label_col)
    return j.groupBy(*keys).agg(*[F.avg(F.when(lab == F.lit(v), F.col(value_col))).alias(n)
                                  for v, n in zip(labels, names)])


def label_table(spark, values: Sequence, key_col: str, label_col: str = "label", first: int = 1) -> DataFrame:
    """A small label table: the i-th value gets label first + i (0 stays the
    background).  Built from a bounded list, no job.  Up to ``INLINE_ROWS``
    entries the rows are literals in the plan (JVM only, no Python worker);
    longer lists are shipped as data so the plan stays small."""
    if 0 < len(values) <= INLINE_ROWS:
        rows = [F.struct(F.lit(None if v is None else str(v)).cast("string").alias(key_col),
                         F.lit(first + i).cast("int").alias(label_col)) for i, v in enumerate(values)]
        return spark.range(1).select(F.inline(F.array(*rows)))
    return spark.createDataFrame([(v, first + i) for i, v in enumerate(values)],
                                 f"{key_col} string, {label_col} int")


# longest list written into a plan as literals
INLINE_ROWS = 1000


def distinct_values(df: DataFrame, col: str, max_values: int = 10_000) -> list:
    """Sorted distinct non-null values of a low-cardinality column; more than
    ``max_values`` raise."""
    rows = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values")
    return sorted(r[0] for r in rows)


def atlas_labels(atlas: DataFrame, atlas_name: str, name_col: str = "atlas",
                 label_col: str = "label", background=0, max_labels: int = 10_000) -> list:
    """Sorted label list of one atlas; an unknown atlas name is an error.

    The list is bounded (``max_labels``) -- it becomes the pivot's column list.
    """
    rows = (atlas.filter(F.col(name_col) == F.lit(atlas_name))
                 .filter(F.col(label_col) != F.lit(background))
                 .select(label_col).distinct().orderBy(label_col)
                 .limit(max_labels + 1).collect())
    if not rows:
        raise OSError(f"there is no atlas {atlas_name}")
    if len(rows) > max_labels:
        raise ValueError("too many labels for a wide region table")
    return [r[0] for r in rows]


def distinct_sorted_int(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Distinct values cast to bigint, sorted (e.g. person numbers)."""
    name = name or col
    return df.select(F.col(col).cast("bigint").alias(name)).distinct().orderBy(name)


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NaN -> null for floating columns (Spark counts and averages NaN,
    pandas skips it)."""
    types = dict(df.dtypes)
    for c in cols:
        if types.get(c) in ("double", "float"):
            df = df.withColumn(c, F.nanvl(F.col(c), F.lit(None).cast(types[c])))
    return df


# ---------------------------------------------------------------- quantiles
# probabilities whose approximate values cut a column into ranges
GRID = 1000


def _grid_column(c: str, accuracy: int) -> Column:
    return F.percentile_approx(F.col(c).cast("double"), [g / GRID for g in range(GRID + 1)], accuracy)


def _grids(df: DataFrame, cols: Sequence[str], accuracy: int, *more: Column):
    """One pass: per column (count, min, max, values at the grid), and ``more``."""
    row = df.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                            _grid_column(c, accuracy).alias("cuts")).alias(f"g{i}") for i, c in enumerate(cols)], *more).first()
    return {c: tuple(row[f"g{i}"]) for i, c in enumerate(cols)}, row


def values_at_ranks(df: DataFrame, wanted: dict, bins: int = 10_000, max_candidates: int = 20_000,
                    grids: dict | None = None) -> dict:
    """Exact values at 0-based ranks of numeric columns, nulls/NaN skipped.

    ``wanted`` is {column: [rank, ...]}; returns {(column, rank): value}.
    Three passes over the data, no column is ever sorted or gathered whole:

    1. count, bounds, and approximate values at a grid of probabilities
       (a mergeable sketch with a rank error of 1 / ``bins``);
    2. how many values lie below and at the two grid values around each rank;
       a rank that falls on one of them is found;
    3. the distinct values of the ranges that hold the other ranks, with their
       counts (summed before they are shuffled, so ties cost one row).

    Up to ``max_candidates`` distinct values are then read off on the driver;
    more are dealt out by range, and each rank is picked from the one partition
    that holds it.  Values are compared as doubles: integers beyond 2^53
    raise.  ``grids`` {column: (count, min, max, cuts)} skips the first pass."""
    cols = list(wanted)
    df = nan_to_null(df.select(*cols), cols)
    if grids is None:
        grids, _ = _grids(df, cols, bins)
    found, spans = {}, {}                   # spans: (column, lo, hi) -> ranks
    for c in cols:
        n, lo, hi, cuts = grids[c]
        for r in wanted[c]:
            if not n or r < 0 or r >= n:
                raise ValueError(f"rank {r} outside 0..{n - 1} for {c}")
            if df.schema[c].dataType.typeName() == "long" and max(abs(lo), abs(hi)) > 1 << 53:
                raise ValueError(f"{c} holds integers that a double cannot tell apart")
            g = int(r / n * GRID)
            spans.setdefault((c, float(cuts[max(0, g - 1)]), float(cuts[min(GRID, g + 2)])), []).append(r)
    if not spans:
        return {}
    counts = []
    for k, (c, lo, hi) in enumerate(spans):
        x = F.col(c).cast("double")
        counts += [F.count(F.when(cond, 1)).alias(f"{name}{k}") for name, cond in
                   (("a", x < lo), ("b", x <= lo), ("c", x < hi), ("d", x <= hi))]
    row = df.agg(*counts).first()
    # open intervals still in question: (column, above, below; None: no bound) -> {rank: place inside}
    inside: dict = {}
    for k, ((c, lo, hi), ranks) in enumerate(spans.items()):
        below_lo, upto_lo, below_hi, upto_hi = (row[f"{x}{k}"] for x in "abcd")
        for r in ranks:
            if below_lo <= r < upto_lo:
                found[(c, r)] = lo
            elif below_hi <= r < upto_hi:
                found[(c, r)] = hi
            elif r < below_lo:              # the sketch was off
                inside.setdefault((c, None, lo), {})[r] = r
            elif r < below_hi:
                inside.setdefault((c, lo, hi), {})[r] = r - upto_lo
            else:
                inside.setdefault((c, hi, None), {})[r] = r - upto_hi
    if inside:
        entries = []
        for k, (c, lo, hi) in enumerate(inside):
            x = F.col(c).cast("double")
            within = x < hi if lo is None else x > lo if hi is None else (x > lo) & (x < hi)
            entries.append(F.when(within, F.struct(F.lit(k).alias("k"), x.alias("x"))))
        values = (df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
                    .groupBy("e.k", "e.x").agg(F.count(F.lit(1)).alias("n")))
        places = [(k, r, at) for k, ranks in enumerate(inside.values()) for r, at in ranks.items()]
        names = list(inside)
        for (k, r), v in _pick(values, places, max_candidates).items():
            found[(names[k][0], r)] = v
    return found


def _pick(values: DataFrame, places: list, max_candidates: int) -> dict:
    """{(k, r): x} for ``places`` (k, r, at): the ``at``-th of the values x of
    interval k, each counted n times."""
    import bisect

    from voxelframe.session import materialize
    from voxelframe.tables import small_table
    values = materialize(values)
    few = values.limit(max_candidates + 1).collect()
    if len(few) <= max_candidates:
        out = {}
        for k in {k for k, _, _ in places}:
            xs = sorted((r["x"], r["n"]) for r in few if r["k"] == k)
            upto, total = [], 0
            for _, n in xs:
                total += n
                upto.append(total)
            for _, r, at in (p for p in places if p[0] == k):
                out[(k, r)] = xs[bisect.bisect_right(upto, at)][0]
        return out
    spark = values.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(values.repartitionByRange(parts, "k", "x").select("*", F.spark_partition_id().alias("part")))
    sums = {(r["k"], r["part"]): r["n"] for r in dealt.groupBy("k", "part").agg(F.sum("n").alias("n")).collect()}
    wanted = []
    for k, r, at in places:
        for part in sorted(p for j, p in sums if j == k):
            if at < sums[(k, part)]:
                wanted.append((k, r, part, at))
                break
            at -= sums[(k, part)]
    asked = F.broadcast(small_table(spark, wanted, "k int, r bigint, part int, at bigint"))
    # the partitions that hold a rank, and in them running counts by value
    w = Window.partitionBy("k", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    held = dealt.join(asked.select("k", "part").distinct(), ["k", "part"], "left_semi").withColumn("upto", F.sum("n").over(w))
    hit = held.join(asked, ["k", "part"]).filter((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n")))
    return {(r["k"], r["r"]): r["x"] for r in hit.select("k", "r", "x").collect()}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    bins: int = 10_000, max_candidates: int = 20_000, grids: dict | None = None) -> dict:
    """Exact linear-interpolation quantiles of each column (NumPy's default):
    the values at ranks floor(p (n-1)) and the next one, interpolated.
    Returns ``{col: [q for q in probs]}`` (None for an all-null column)."""
    cols = list(cols)
    df = nan_to_null(df.select(*cols), cols)
    if grids is None:
        grids, _ = _grids(df, cols, bins)
    wanted = {}
    for c in cols:
        n = grids[c][0]
        if n:
            ks = set()
            for p in probs:
                k = int(p * (n - 1))
                ks |= {k, min(k + 1, n - 1)}
            wanted[c] = sorted(ks)
    vals = values_at_ranks(df, wanted, bins, max_candidates, {c: grids[c] for c in wanted}) if wanted else {}
    out = {}
    for c in cols:
        n = grids[c][0]
        res = []
        for p in probs:
            if not n:
                res.append(None)
                continue
            h = p * (n - 1)
            k = int(h)
            a = vals[(c, k)]
            b = vals[(c, min(k + 1, n - 1))]
            res.append(a + (b - a) * (h - k))
        out[c] = res
    return out


def describe(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column, one row per
    column (the shape of a transposed pandas ``describe``), in three passes
    over just these columns: moments, bounds and grid, then two for the exact
    quartiles (``values_at_ranks``)."""
    spark = df.sparkSession
    df = nan_to_null(df.select(*cols), cols)
    grids, base = _grids(df, cols, 10_000, *[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(f"s{i}")
                                             for i, c in enumerate(cols)])
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], grids=grids)
    rows = []
    for i, c in enumerate(cols):
        n, lo, hi, _ = grids[c]
        rows.append((c, int(n), base[f"s{i}"]["mean"], base[f"s{i}"]["std"], None if lo is None else float(lo), *q[c],
                     None if hi is None else float(hi)))
    out = small_table(spark, rows, "column string, count bigint, mean double, std double, min double, "
                                      "q25 double, q50 double, q75 double, max double")
    r = lambda c: F.round(F.col(c), digits) + F.lit(0.0)
    return out.select("column", "count", *[r(c).alias(c) for c in
                                           ("mean", "std", "min", "q25", "q50", "q75", "max")])


def high_variance_features(long: DataFrame, keys: Sequence[str], feature: str, value: str,
                           percentile: float = 2.0) -> DataFrame:
    """Per group, the features whose population variance over time is above
    the (100 - percentile)-th percentile of all feature variances.

    The per-(group, feature) variances are a partial aggregate; the
    threshold is an exact percentile over those (one value per feature, a
    table bounded by the feature count of a group).
    """
    v = long.groupBy(*keys, feature).agg(F.var_pop(value).alias("var"))
    thr = v.groupBy(*keys).agg(F.percentile("var", 1.0 - percentile / 100.0).alias("_thr"))
    from voxelframe.operators.joins import broadcast_if_small
    # one threshold per group, joined back without moving a big group's rows
    return v.join(broadcast_if_small(thr), list(keys)).filter(F.col("var") > F.col("_thr")).drop("_thr")

"""Gradient-boosted trees per target region (pyspark.ml; large tables as sums
per cell of feature bins) and the feature importance table behind the
importance plot."""

from __future__ import annotations

import math
import uuid
from typing import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.functions.numeric import DRAW_BITS, draw
from voxelframe.tables import small_table

# Fixed values of the reference's boosted-tree configuration that Spark has:
# depth 4, learning rate 0.08, row subsample 0.95, seed 0.
GBT_DEFAULTS = {"maxDepth": 4, "stepSize": 0.08, "subsamplingRate": 0.95, "seed": 0}
MAX_ITER = 500

# boosting ends early once PATIENCE further trees have not lowered the best
# error on held-out rows; trees are built FIRST, then GROWTH times as many
HELD_OUT, PATIENCE, FIRST, GROWTH = 0.2, 30, 40, 4


# settings under which boosting on cells builds the trees of boosting on rows
CELL_PARAMS = {"maxDepth", "stepSize", "subsamplingRate", "seed", "maxBins"}
CELL_BINS = 256
# from that many rows on; below, passes over the rows take less than the wait
# for a fit per tree.  Both ways build the same trees
CELLS_FROM = 1000000
# trees whose row draws are added up in one pass over the rows
DRAWS_AT_ONCE = 10
# rows the candidate thresholds are chosen from, as in Spark's trees
THRESHOLD_ROWS = 10000
# cells a task holds at least, if there are as many: trees on few cells wait
# for tasks more than for the work
CELLS_A_TASK = 20000


def _sample(df: DataFrame, share: float, seed: int) -> DataFrame:
    """Rows drawn as ``GBTRegressor`` draws them for its thresholds."""
    spark = df.sparkSession
    drawn = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    rows = df._jdf.toJavaRDD().sample(False, share, drawn)
    return DataFrame(spark._jsparkSession.createDataFrame(rows, df._jdf.schema()), spark)


def _thresholds(values: np.ndarray, expected: float, most: int) -> list[float]:
    """Candidate thresholds of one feature from its sampled values: all
    midpoints if there are at most ``most``, else about equal shares.  Zeros
    are counted as in Spark, as what is missing from the ``expected`` rows."""
    nonzero = values[values != 0]
    v, n = np.unique(nonzero, return_counts=True)
    if expected - len(nonzero) > np.finfo(float).eps * len(nonzero) * 100:
        at = np.searchsorted(v, 0.0)
        v, n = np.insert(v, at, 0.0), np.insert(n.astype(float), at, expected - len(nonzero))
    mid = [float(m) for m in (v[:-1] + v[1:]) / 2]
    if len(mid) <= most:
        return mid
    cuts, stride, seen = [], expected / (most + 1), np.cumsum(n)
    aim = stride
    for k, m in enumerate(mid):
        if abs(seen[k] - aim) < abs(seen[k + 1] - aim):
            cuts.append(m)
            aim += stride
    return cuts


class CellBoosting:
    """Spark's boosted regression trees, built from sums per cell of bins.

    A tree sees of a row only the bins its features fall in (at most
    ``maxBins`` each), and the error left in a cell of bins follows from the
    count and label sum of the rows drawn for that tree, as the trees so far
    predict the same for all of a cell.  So the rows are read once for
    ``DRAWS_AT_ONCE`` trees, and each tree is a ``DecisionTreeRegressor`` on
    the cells' mean errors weighted by their counts: a cell's own scatter adds
    the same to a node as to its two children, which leaves gains and
    predictions as they are.  Thresholds and row draws are those of
    ``GBTRegressor`` on the same partitions; more trees can be added later."""

    def __init__(self, df: DataFrame, feats: Sequence[str], target: str, maxDepth: int, stepSize: float,
                 subsamplingRate: float, seed: int, maxBins: int = 32):
        self.spark, self.feats, self.target = df.sparkSession, list(feats), target
        self.depth, self.step, self.share, self.seed, self.bins = maxDepth, stepSize, subsamplingRate, seed, maxBins
        rows = self._whole(df)
        n = rows.count()
        share = min(1.0, max(maxBins * maxBins, THRESHOLD_ROWS) / n)
        x = rows.select(*self._x)
        seen = np.array((_sample(x, share, seed) if share < 1 else x).collect(), float).reshape(-1, len(self.feats))
        self.cuts = [_thresholds(seen[:, i], share * n, min(maxBins, n) - 1) for i in range(len(self.feats))]
        self.rows = self._binned(rows)
        # no more cells than combinations of bins, or rows
        self.tasks = -(-min(n, math.prod(len(c) + 1 for c in self.cuts)) // CELLS_A_TASK)
        self._trees: list = []
        ml = self.spark._jvm.org.apache.spark.ml
        self._inner, self._split = ml.tree.InternalNode, ml.tree.ContinuousSplit
        self._tree_model, self._model = ml.regression.DecisionTreeRegressionModel, ml.regression.GBTRegressionModel

    @property
    def _x(self) -> list[str]:
        return [f"_x{i}" for i in range(len(self.feats))]

    @property
    def _bin(self) -> list[str]:
        return [f"_bin{i}" for i in range(len(self.feats))]

    def _whole(self, df: DataFrame) -> DataFrame:
        """Features and label as doubles; a null, NaN or infinite feature and
        a null or NaN label are errors, as in Spark's fit."""
        def checked(c, bad):
            x = F.col(c).cast("double")
            return F.when(bad(x), F.raise_error(F.lit(f"{c}: null, NaN or infinite value"))).otherwise(x)
        return df.select(
            *[checked(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))).alias(a)
              for c, a in zip(self.feats, self._x)],
            checked(self.target, lambda x: x.isNull() | F.isnan(x)).alias("_y"))

    def _binned(self, rows: DataFrame) -> DataFrame:
        """The bin of each feature: how many thresholds lie below the value."""
        cut = [i for i, c in enumerate(self.cuts) if c]
        if cut:
            # a bucket holds its lower end, a bin its upper one: ends are moved by one double
            ends = [[-np.inf, *np.nextafter(self.cuts[i], np.inf).tolist(), np.inf] for i in cut]
            rows = Bucketizer(inputCols=[self._x[i] for i in cut], outputCols=[self._bin[i] for i in cut],
                              splitsArray=ends).transform(rows)
        return rows.select(*[(F.col(b).cast("int") if c else F.lit(0)).alias(b) for b, c in zip(self._bin, self.cuts)], "_y")

    def _vector(self, cells: DataFrame, values: list[list[float]], name: str) -> DataFrame:
        """One value per feature and bin, assembled."""
        cols = [F.get(F.array(*[F.lit(v) for v in vs]), F.col(b)).alias(x)
                for vs, b, x in zip(values, self._bin, self._x)]
        return VectorAssembler(inputCols=self._x, outputCol=name).transform(cells.select("*", *cols)).drop(*self._x)

    def _features(self, cells: DataFrame) -> DataFrame:
        """A value of each bin: its upper threshold, in the last one the next double."""
        return self._vector(cells, [[*c, float(np.nextafter(c[-1], np.inf))] if c else [0.0] for c in self.cuts], "_features")

    def _cells(self, first: int, end: int) -> DataFrame:
        """Per cell and tree the count and label sum of the rows drawn for it."""
        drawn = self.rows.select("*", *[(F.rand(self.seed + m + 1) < self.share).alias(f"_in{m}") for m in range(first, end)])
        sums = [a for m in range(first, end) for a in
                (F.count(F.when(F.col(f"_in{m}"), 1)).alias(f"_n{m}"), F.sum(F.when(F.col(f"_in{m}"), F.col("_y"))).alias(f"_s{m}"))]
        cells = self._features(drawn.groupBy(*self._bin).agg(*sums).coalesce(self.tasks))
        # bin k is told to the tree as -4^-k: a threshold midway between two
        # bins then names the lower one, also if no row is in those between
        cells = self._vector(cells, [[-(4.0 ** -k) for k in range(len(c) + 1)] for c in self.cuts], "_codes")
        return self._predicted(cells, 0, first).withColumnRenamed("_pred", "_before")

    def _tree(self, cells: DataFrame, n_cells: int, first: int):
        m = len(self._trees)
        mean = F.col(f"_s{m}") / F.col(f"_n{m}")
        left = 2 * (mean - F.col("_before") - F.col("_pred")) if m else mean
        here = self._predicted(cells.filter(F.col(f"_n{m}") > 0), first, m).select(
            "_codes", left.alias("_left"), F.col(f"_n{m}").cast("double").alias("_n"))
        # that many bins: thresholds are then taken from all cells, not from a sample
        dt = DecisionTreeRegressor(featuresCol="_codes", labelCol="_left", weightCol="_n", maxDepth=self.depth,
                                   maxBins=max(self.bins, math.isqrt(n_cells) + 1), seed=self.seed + m)
        model = dt.fit(here)
        fitted = model._java_obj        # released with ``model``

        def own(node):
            """The node with thresholds of the features in place of codes."""
            if node.subtreeDepth() == 0:
                return node
            split = node.split()
            f = split.featureIndex()
            # -2t is 4^-k or up to 1.25 times as much; frexp gives its power of two
            k = (1 - math.frexp(-2 * split.threshold())[1]) // 2
            return self._inner(node.prediction(), node.impurity(), node.gain(), own(node.leftChild()),
                               own(node.rightChild()), self._split(f, self.cuts[f][k]), node.impurityStats())
        return self._tree_model(fitted.uid(), own(fitted.rootNode()), len(self.feats))

    def grow(self, n: int) -> None:
        """Add trees until there are ``n``."""
        while len(self._trees) < n:
            first = len(self._trees)
            end = min(n, first + DRAWS_AT_ONCE)
            cells = self._cells(first, end).persist()
            try:
                n_cells = cells.count()
                while len(self._trees) < end:
                    self._trees.append(self._tree(cells, n_cells, first))
            finally:
                cells.unpersist()

    def _boosted(self, first: int, end: int):
        """Trees ``first`` to ``end`` (exclusive) as a model of the JVM."""
        gateway = self.spark.sparkContext._gateway
        trees = gateway.new_array(self._tree_model, end - first)
        weights = gateway.new_array(gateway.jvm.double, end - first)
        for k in range(first, end):
            trees[k - first], weights[k - first] = self._trees[k], self.step if k else 1.0
        made = self._model(f"GBTRegressor_{uuid.uuid4().hex[:12]}", trees, weights, len(self.feats))
        return made.setFeaturesCol("_features").setPredictionCol("_pred")

    def _predicted(self, cells: DataFrame, first: int, end: int) -> DataFrame:
        """With what trees ``first`` to ``end`` (exclusive) add up to."""
        if first == end:
            return cells.withColumn("_pred", F.lit(0.0))
        return DataFrame(self._boosted(first, end).transform(cells._jdf), self.spark)

    def model(self, n: int) -> GBTRegressionModel:
        """The first ``n`` trees as a model."""
        made = GBTRegressionModel(self._boosted(0, n))
        made._transfer_params_from_java()
        made.set(made.labelCol, self.target)
        made.set(made.maxIter, n)
        return made

    def held_cells(self, held: DataFrame) -> DataFrame:
        """Mean label and count per cell of other rows."""
        cells = self._binned(self._whole(held)).groupBy(*self._bin).agg(
            F.avg("_y").alias(self.target), F.count(F.lit(1)).cast("double").alias("_n"))
        return self._features(cells).select("_features", self.target, "_n")

    def errors(self, cells: DataFrame, n: int) -> list[float]:
        """Squared error of 1 to ``n`` trees on ``held_cells`` (less the
        scatter inside cells, which no tree changes)."""
        self.grow(n)
        made = self.model(n)
        made.set(made.weightCol, "_n")
        made._transfer_params_to_java()
        return made.evaluateEachIteration(cells, "squared")


def _best_count(errors_of, max_iter: int) -> int:
    """How many trees have the least error, ``errors_of(n)`` giving those of
    1 to ``n`` trees on held-out rows.

    Spark's own validation stops at the first tree that gains too little, so
    the errors of all trees built are read instead."""
    n = min(FIRST, max_iter)
    while True:
        errors = errors_of(n)
        best = min(range(n), key=errors.__getitem__) + 1
        if n == max_iter or n - best >= PATIENCE:
            return best
        n = min(n * GROWTH, max_iter)


def _best_count_of_cells(boosting: CellBoosting, held: DataFrame, max_iter: int) -> int:
    cells = boosting.held_cells(held).persist()
    try:
        return _best_count(lambda n: boosting.errors(cells, n), max_iter)
    finally:
        cells.unpersist()


def _fit_cells(df: DataFrame, feats: Sequence[str], target: str, n: int, params: dict) -> GBTRegressionModel:
    boosting = CellBoosting(df, feats, target, **params)
    boosting.grow(n)
    return boosting.model(n)


def fit_region(df: DataFrame, cols: Sequence[str], target: str, max_iter: int = MAX_ITER,
               id_cols: Sequence[str] = (), min_gain: float | None = None, **kw):
    """Fit one region from all the others; returns (model, feature names).

    With ``id_cols`` a seeded share of the rows is held out to choose the
    number of trees, the one with the least error on them (the search ends
    once ``PATIENCE`` further trees have not lowered it); that many trees are
    then fitted on all rows.  With ``min_gain`` boosting ends at the first tree
    that lowers the held-out error by less than this share.  Without
    ``id_cols`` (or if no row is held out), all ``max_iter`` trees are built.
    Large tables are fitted by ``CellBoosting``."""
    feats = [c for c in cols if c != target]
    va = VectorAssembler(inputCols=feats, outputCol="_features")
    params = {**GBT_DEFAULTS, **kw}
    gbt = GBTRegressor(featuresCol="_features", labelCol=target, predictionCol="_pred",
                       maxIter=max_iter, **params)
    by_cells = (set(params) <= CELL_PARAMS and params.get("maxBins", 32) <= CELL_BINS
                and min_gain is None and df.count() >= max(1, CELLS_FROM))
    if id_cols:
        test = draw(params["seed"], *[F.col(c) for c in id_cols]) < int(HELD_OUT * (1 << DRAW_BITS))
        rows = va.transform(df.withColumn("_held", test))
        if min_gain is not None:
            model = gbt.setParams(validationIndicatorCol="_held", validationTol=min_gain).fit(rows)
            return model, feats, va
        train, held = rows.filter(~F.col("_held")), rows.filter("_held")
        if not held.isEmpty() and not train.isEmpty():
            if by_cells:
                best = _best_count_of_cells(CellBoosting(train, feats, target, **params), held, max_iter)
                return _fit_cells(df, feats, target, best, params), feats, va

            def errors_of(n):
                return gbt.copy({gbt.maxIter: n}).fit(train).evaluateEachIteration(held, "squared")
            return gbt.copy({gbt.maxIter: _best_count(errors_of, max_iter)}).fit(rows), feats, va
    if by_cells:
        return _fit_cells(df, feats, target, max_iter, params), feats, va
    model = gbt.fit(va.transform(df))
    return model, feats, va


def predict(model, va, df: DataFrame) -> DataFrame:
    return model.transform(va.transform(df)).drop("_features")


def importance_table(spark: SparkSession, model, feats: Sequence[str], region: str,
                     top: int = 50) -> DataFrame:
    """(region, feature, importance) for the ``top`` most important features."""
    imp = model.featureImportances.toArray()
    rows = [(region, f, float(v)) for f, v in zip(feats, imp)]
    return (small_table(spark, rows, "region string, feature string, importance double")
                 .orderBy(F.desc("importance"), "feature").limit(top))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml.regression import GBTRegressionModel
    return GBTRegressionModel.load(path)


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved model: (tree, node, feature, threshold, gain,
    rows); feature (an index) and threshold are null in leaves."""
    n = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    return n.select(F.col("treeID").alias("tree"), F.col("id").alias("node"),
                    F.when(inner, F.col("split.featureIndex")).alias("feature"),
                    F.when(inner & (F.col("split.numCategories") < 0),
                           F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
                    F.when(inner, F.col("gain")).alias("gain"), F.col("impurityStats")[0].cast("bigint").alias("rows"))


def split_counts(spark: SparkSession, path: str, feats: Sequence[str], region: str, top: int = 50) -> DataFrame:
    """(region, feature, splits, gain, rows) of a saved model: how often each
    feature is split on, and the gain and rows of those splits added up; the
    ``top`` most frequent, features without a split not at all."""
    names = F.array(*[F.lit(f) for f in feats])
    counts = node_table(spark, path).filter("feature is not null").groupBy("feature").agg(
        F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"), F.sum("rows").alias("rows"))
    return (counts.select(F.lit(region).alias("region"), F.get(names, F.col("feature")).alias("feature"), "splits", "gain", "rows")
                  .orderBy(F.desc("splits"), "feature").limit(top))


def side_by_side(spark: SparkSession, work, items: Sequence, at_once: int) -> list:
    """``work(item)`` for every item in threads of one Spark application, up to
    ``at_once`` together; results in order.  Each thread inherits the caller's
    job group and local properties and has a scheduler pool of its own, so with
    the FAIR scheduler (``session.DEFAULT_CONF``) the jobs share the cores
    evenly.  The first error is raised after the running ones have ended."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    sc = spark.sparkContext

    def one(place, item):
        sc.setLocalProperty("spark.scheduler.pool", f"side_{place % at_once}")
        return work(item)
    if at_once <= 1 or len(items) <= 1:
        return [work(i) for i in items]
    with ThreadPoolExecutor(at_once) as threads:
        # each submission wraps anew: the properties are those of this thread
        running = [threads.submit(inheritable_thread_target(one), k, i) for k, i in enumerate(items)]
        return [r.result() for r in running]


# region fits that run together
FITS_AT_ONCE = 4


def fit_all_regions(df: DataFrame, cols: Sequence[str], max_iter: int = MAX_ITER, split_col: str | None = None,
                    id_cols: Sequence[str] = (), at_once: int = FITS_AT_ONCE, **kw):
    """Boosted trees for every region from all the others.

    The input is cached once and read by every fit; ``at_once`` regions are
    fitted side by side (the models do not depend on it), as one tree level of
    one region rarely fills a cluster.  Returns (importance rows, score rows
    (region, split, n, r2, mae)) as DataFrames.
    """
    from pyspark import StorageLevel

    from voxelframe.operators.metrics import regression_metrics
    spark = df.sparkSession
    keep = list(dict.fromkeys([*cols, *([split_col] if split_col else []), *id_cols]))
    d = df.select(*keep).persist(StorageLevel.MEMORY_AND_DISK)

    def one(target):
        train = d.filter(F.col(split_col) == "train") if split_col else d
        model, feats, va = fit_region(train, cols, target, max_iter=max_iter, id_cols=id_cols, **kw)
        m = regression_metrics(predict(model, va, d), [split_col] if split_col else [], target, "_pred").collect()
        return ([(target, f, float(v)) for f, v in zip(feats, model.featureImportances.toArray())],
                [(target, r[split_col] if split_col else "all", int(r["n"]), r["r2"], r["mae"]) for r in m])
    try:
        d.count()               # cached before the fits start together
        done = side_by_side(spark, one, list(cols), at_once)
        imps, scores = ([r for part in parts for r in part] for parts in zip(*done)) if done else ([], [])
    finally:
        d.unpersist()
    return (small_table(spark, imps, "region string, feature string, importance double"),
            small_table(spark, scores, "region string, split string, n bigint, r2 double, mae double"))

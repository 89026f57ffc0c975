"""Feed-forward nets for every target region, scored and trained as Spark
jobs.

Architecture per target: (d-1) -> hidden layers -> 1 with Softplus on all
hidden layers but the last, which has Tanh.  Weights live in a small table
(cohort, region, layer, rows, cols, w, b); its size depends on the
architecture and region count, never on the data, so it is shipped to the
tasks with the function.

Scoring: each Arrow batch is pushed through all nets at once and only
per-target metric sums leave the task, relative to a row of the data so that
no precision is lost on unscaled regions.

Training: one Spark job per epoch, in one of two forms.

* ``train_synchronous``: the train rows in a total order are cut into slices of
  ``batch_rows``; a barrier stage of a few tasks holds an even share of every
  slice each, the tasks exchange their gradients slice by slice, and every
  slice gives one Adam update.  The result is that of one machine working
  through the same slices, however many tasks share them.
* ``train``: every partition makes one Adam update per slice of its own rows on
  its own copy of the nets; the copies (weights and moments) are averaged by
  rows after the epoch, in two levels of groups (no call receives more than the
  square root of the partitions).  Spreads over any number of tasks, but is not
  one sequence of updates.

Training stops when the error no longer falls.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: hidden sizes, learning rate and slice of the published nets
HIDDEN = (100, 50, 25)
LEARNING_RATE = 1e-2
BATCH_ROWS = 8096
# rows pushed through a net at once: their activations (about 3 KB a row) stay
# in the cache, and memory does not grow with the rows of a batch or slice
BLOCK_ROWS = 256
WEIGHTS_SCHEMA = "cohort string, region string, layer int, rows int, cols int, w array<double>, b array<double>"


def _softplus(z):
    return np.where(z > 20, z, np.log1p(np.exp(np.minimum(z, 20))))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-z))


def init_net(rng: np.random.Generator, d_in: int, hidden: Sequence[int] = HIDDEN) -> list[tuple[np.ndarray, np.ndarray]]:
    """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) init, weights (out, in)."""
    sizes = (d_in, *hidden, 1)
    layers = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        k = 1.0 / np.sqrt(a)
        layers.append((rng.uniform(-k, k, (b, a)), rng.uniform(-k, k, b)))
    return layers


def forward(layers, x):
    """Activations and pre-activations of every layer."""
    hs, zs = [x], []
    for i, (w, b) in enumerate(layers):
        z = hs[-1] @ w.T + b
        zs.append(z)
        hidden = len(layers) - 1
        hs.append(z if i == hidden else np.tanh(z) if i == hidden - 1 else _softplus(z))
    return hs, zs


def backward(layers, hs, zs, y):
    """Gradients of sum((out - y)^2) w.r.t. every weight and bias."""
    d = (2.0 * (hs[-1][:, 0] - y))[:, None]
    grads = [None] * len(layers)
    for i in range(len(layers) - 1, -1, -1):
        grads[i] = (d.T @ hs[i], d.sum(axis=0))
        if i > 0:
            slope = (1.0 - hs[i] ** 2) if i == len(layers) - 1 else _sigmoid(zs[i - 1])
            d = (d @ layers[i][0]) * slope
    return grads


def flatten(layers) -> np.ndarray:
    return np.concatenate([np.concatenate([w.ravel(), b.ravel()]) for w, b in layers])


def predict(layers, x) -> np.ndarray:
    """Outputs of a net, block by block of rows."""
    out = np.empty(len(x))
    for at in range(0, len(x), BLOCK_ROWS):
        out[at:at + BLOCK_ROWS] = forward(layers, x[at:at + BLOCK_ROWS])[0][-1][:, 0]
    return out


def gradient(layers, x, y) -> np.ndarray:
    """``backward`` of all rows as one vector, summed block by block."""
    total = np.zeros(sum(w.size + b.size for w, b in layers))
    for at in range(0, len(x), BLOCK_ROWS):
        some = x[at:at + BLOCK_ROWS]
        total += flatten(backward(layers, *forward(layers, some), y[at:at + BLOCK_ROWS]))
    return total


def unflatten(vec: np.ndarray, d_in: int, hidden: Sequence[int] = HIDDEN):
    sizes = (d_in, *hidden, 1)
    out, k = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        w = vec[k:k + a * b].reshape(b, a)
        k += a * b
        bb = vec[k:k + b]
        k += b
        out.append((w, bb))
    return out


def weights_table(spark: SparkSession, nets: dict, cohort: str) -> DataFrame:
    """Nets {region: layers} as rows of the weights table."""
    rows = [(cohort, region, i, int(w.shape[0]), int(w.shape[1]), w.ravel().tolist(), b.tolist())
            for region, layers in nets.items() for i, (w, b) in enumerate(layers)]
    return spark.createDataFrame(rows, WEIGHTS_SCHEMA)


def nets_from_table(weights: DataFrame, cohort: str, max_rows: int = 10_000) -> dict:
    """Read one cohort's nets (the table is bounded by regions x layers)."""
    rows = weights.filter(F.col("cohort") == cohort).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("weights table larger than expected")
    nets: dict = {}
    for r in sorted(rows, key=lambda r: (r["region"], r["layer"])):
        w = np.array(r["w"]).reshape(r["rows"], r["cols"])
        nets.setdefault(r["region"], []).append((w, np.array(r["b"])))
    return nets


METRICS = ("n", "sy", "syy", "sp", "spp", "see", "sae")
METRIC_SCHEMA = "region string, split string, " + ", ".join(f"{m} double" for m in METRICS)


def _metric_sums(y, p, shift: float) -> np.ndarray:
    e, y, p = y - p, y - shift, p - shift
    return np.array([len(y), y.sum(), y @ y, p.sum(), p @ p, e @ e, np.abs(e).sum()])


def _shift(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """A row of the data: sums of squares relative to it lose no precision."""
    row = df.select(*cols).dropna().first()
    return np.zeros(len(cols)) if row is None else np.array([float(v) for v in row])


def metrics_from_sums(s: DataFrame) -> DataFrame:
    """r2 (target denominator), r2 with swapped arguments, mse, mae from sums
    relative to one shift per region."""
    n = F.col("n")
    sst_y = F.col("syy") - F.col("sy") * F.col("sy") / n
    sst_p = F.col("spp") - F.col("sp") * F.col("sp") / n

    def r2(sst):
        return F.when(sst > 0, 1 - F.col("see") / sst).when(F.col("see") == 0, 1.0).otherwise(0.0)

    return s.select("region", "split", n.cast("bigint").alias("n"), r2(sst_y).alias("r2"),
                    r2(sst_p).alias("r2_swapped"), (F.col("see") / n).alias("mse"),
                    (F.col("sae") / n).alias("mae"))


def score(df: DataFrame, cols: Sequence[str], nets: dict, split_col: str | None = None) -> DataFrame:
    """Metrics of every region's net, one pass, per split (if given)."""
    cols = list(cols)
    sel = cols + ([split_col] if split_col else [])
    bc = df.sparkSession.sparkContext.broadcast(nets)   # shipped once per executor
    shift = _shift(df, cols)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict = {}
        for pdf in it:
            x_all = pdf[cols].to_numpy(dtype=np.float64)
            splits = pdf[split_col].astype(str).to_numpy() if split_col else np.array(["all"] * len(pdf))
            for k, region in enumerate(cols):
                if region not in bc.value or not len(pdf):
                    continue
                p = predict(bc.value[region], np.delete(x_all, k, axis=1))
                for s in np.unique(splits):
                    m = splits == s
                    acc[(region, s)] = acc.get((region, s), 0.0) + _metric_sums(x_all[m, k], p[m], shift[k])
        yield pd.DataFrame([(*k, *v) for k, v in acc.items()], columns=["region", "split", *METRICS])

    sums = df.select(*sel).mapInPandas(run, METRIC_SCHEMA).groupBy("region", "split").agg(
        *[F.sum(c).alias(c) for c in METRICS])
    return metrics_from_sums(sums)


class _Adam:
    """Adam on one flat weight vector; weights and moments travel together."""

    def __init__(self, vector, lr, moments=None, step=0, betas=(0.9, 0.999), eps=1e-8):
        self.p, self.lr, self.betas, self.eps, self.step = vector, lr, betas, eps, step
        self.m, self.v = moments if moments is not None else (np.zeros_like(vector), np.zeros_like(vector))

    def state(self) -> np.ndarray:
        return np.concatenate([self.p, self.m, self.v])

    def update(self, g) -> None:
        a, b = self.betas
        self.step += 1
        self.m, self.v = a * self.m + (1 - a) * g, b * self.v + (1 - b) * g * g
        self.p = self.p - self.lr * (self.m / (1 - a ** self.step)) / (
            np.sqrt(self.v / (1 - b ** self.step)) + self.eps)


def _epoch(batches, nets, moments, cols, split_col, shift, lr, batch_rows):
    """One partition's share of an epoch: metric sums with the nets as they
    came, then an update per slice of train rows on the partition's copy."""
    sums: dict = {}
    copies, rows = {}, 0
    hidden = {r: tuple(len(b) for _, b in layers[:-1]) for r, layers in nets.items()}
    for pdf in batches:
        x_all = pdf[cols].to_numpy(dtype=np.float64)
        train = (pdf[split_col] == "train").to_numpy()
        rows += int(train.sum())
        for k, region in enumerate(cols):
            if region not in nets or not len(pdf):
                continue
            x, y = np.delete(x_all, k, axis=1), x_all[:, k]
            p = predict(nets[region], x)
            for s, m in (("train", train), ("test", ~train)):
                if m.any():
                    sums[(region, s)] = sums.get((region, s), 0.0) + _metric_sums(y[m], p[m], shift[k])
            if region not in copies:
                copies[region] = _Adam(flatten(nets[region]), lr, *moments.get(region, ()))
            adam = copies[region]
            xt, yt = x[train], y[train]
            for at in range(0, len(xt), batch_rows):
                some, want = xt[at:at + batch_rows], yt[at:at + batch_rows]
                layers = unflatten(adam.p, len(cols) - 1, hidden[region])
                adam.update(gradient(layers, some, want) / len(some))
    out = [(r, s, *v, (copies[r].state() * rows).tolist() if s == "train" and rows else None, float(rows),
            float(copies[r].step)) for (r, s), v in sums.items()]
    yield pd.DataFrame(out, columns=["region", "split", *METRICS, "g", "w", "k"])


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    vectors = [np.asarray(g) for g in pdf["g"] if g is not None]
    out = {"region": pdf["region"].iloc[0], "split": pdf["split"].iloc[0], **{m: float(pdf[m].sum()) for m in METRICS},
           "g": np.sum(vectors, axis=0).tolist() if vectors else None,
           "w": float(pdf["w"][pdf["g"].notna()].sum()), "k": float(pdf["k"].max())}
    return pd.DataFrame([out])


def _fit(nets: dict, max_epochs: int, tol: float, patience: int, one_epoch):
    """Epochs until the stop rule holds.  ``one_epoch(nets, moments)`` gives
    ({(region, split): metric sums}, the nets and moments after its updates)."""
    moments: dict = {}
    history, best, stale, least, mark = [], dict(nets), 0, {}, {}
    for epoch in range(max_epochs):
        rows, after, moments = one_epoch(nets, moments)
        errors = {}
        for region in nets:
            vals = {}
            for sp in ("train", "test"):
                r = rows.get((region, sp))
                if r is None:
                    vals[sp] = (None, None)
                    continue
                sst = r["spp"] - r["sp"] ** 2 / r["n"]
                r2 = 1 - r["see"] / sst if sst > 0 else (1.0 if r["see"] == 0 else 0.0)
                vals[sp] = (float(r2), float(r["see"] / r["n"]))
            history.append((region, epoch, vals["train"][0], vals["test"][0], vals["train"][1], vals["test"][1]))
            errors[region] = vals["train"][1]
        fell = [r for r, e in errors.items() if e is not None and (r not in mark or e < mark[r] * (1 - tol))]
        mark.update((r, errors[r]) for r in fell)
        for r, e in errors.items():
            if e is not None and e <= least.get(r, np.inf):
                least[r], best[r] = e, nets[r]
        stale = 0 if fell else stale + 1
        if stale >= patience:
            break
        nets = after
    return best, history


def train(df: DataFrame, cols: Sequence[str], nets: dict, max_epochs: int, lr: float = LEARNING_RATE,
          split_col: str = "split", batch_rows: int = BATCH_ROWS, tol: float = 0.0, patience: int = 3):
    """Mini-batch Adam on the MSE of every region's net, data-parallel.

    Returns (nets, history rows [(region, epoch, r2_train, r2_test,
    mse_train, mse_test)]) with R² computed with swapped arguments as the
    published training loop does; epoch e is measured before its updates.
    Stops after ``max_epochs``, or once no region's train error has fallen
    by the share ``tol`` within ``patience`` epochs, counted from its last fall
    by that much, so slow steady falls add up; of every region the nets
    with the least train error are returned.  ``df`` should be cached by the caller."""
    cols = list(cols)
    hidden = {r: tuple(len(b) for _, b in layers[:-1]) for r, layers in nets.items()}
    sc = df.sparkSession.sparkContext
    shift = _shift(df, cols)
    schema = METRIC_SCHEMA + ", g array<double>, w double, k double"
    data = df.select(*cols, split_col)
    # groups of the first level
    spread = max(1, int(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))

    def one_epoch(nets, moments):
        sent = sc.broadcast((nets, moments))

        def run(it):
            return _epoch(it, *sent.value, cols, split_col, shift, lr, batch_rows)
        parts = data.mapInPandas(run, schema)
        level = parts.groupBy("region", "split", F.pmod(F.spark_partition_id(), F.lit(spread))).applyInPandas(_add, schema)
        rows = {(r["region"], r["split"]): r for r in level.groupBy("region", "split").applyInPandas(_add, schema).collect()}
        sent.unpersist()
        after, moved = {}, dict(moments)
        for r, layers in nets.items():
            row = rows.get((r, "train"))
            if row is not None and row["w"]:
                p, m, v = np.split(np.asarray(row["g"]) / row["w"], 3)
                layers, moved[r] = unflatten(p, len(cols) - 1, hidden[r]), ((m, v), int(row["k"]))
            after[r] = layers
        return rows, after, moved
    return _fit(nets, max_epochs, tol, patience, one_epoch)


# tasks that share a slice: each takes batch_rows / SYNC_TASKS rows of it, and
# every task receives the gradients of all others once a slice
SYNC_TASKS = 12


# longest wait for another task's vector, in seconds
PEER_SECONDS = 1800


class _Exchange:
    """Sums of the tasks' vectors, one a slice.  With a mounted folder a vector
    is a file there, put into place whole, and the tasks read each other's as
    they appear: a barrier call takes a second, however little it carries.  A
    task that has all vectors of a slice knows that all are done with the
    slice before and removes its own file of that."""

    def __init__(self, context, folder: str | None):
        import uuid
        self.context, self.folder, self.mine = context, folder, None
        self.names = context.allGather(uuid.uuid4().hex) if folder else []        # of this attempt

    def total(self, s: int, vector: np.ndarray) -> np.ndarray:
        import base64
        import os
        if self.folder is None:
            told = self.context.allGather(base64.b64encode(vector.tobytes()).decode())
            return sum(np.frombuffer(base64.b64decode(t)) for t in told)
        place = self.context.partitionId()
        paths = [os.path.join(self.folder, f"{name}-{s}") for name in self.names]
        vector.tofile(paths[place] + ".draft")
        os.replace(paths[place] + ".draft", paths[place])
        found = sum(vector if i == place else self._read(p) for i, p in enumerate(paths))
        if self.mine:
            os.remove(self.mine)
        self.mine = paths[place]
        return found

    @staticmethod
    def _read(path: str) -> np.ndarray:
        import time
        end = time.monotonic() + PEER_SECONDS
        while True:
            try:
                return np.fromfile(path)
            except FileNotFoundError:
                if time.monotonic() > end:
                    raise
                time.sleep(0.0005)


def _slices(batches, cols):
    """Rows sorted by slice -> (slice, rows) with the rows of each slice together;
    rows of slice -1, any number of them, come batch by batch."""
    held, number = [], None
    for pdf in batches:
        for s, some in pdf.groupby("_slice", sort=True):
            if held and (s != number or s == -1):
                yield number, np.concatenate(held)
                held = []
            number = s
            held.append(some[cols].to_numpy(dtype=np.float64))
    if held:
        yield number, np.concatenate(held)


def _sync_epoch(batches, nets, moments, cols, shift, lr, n_slices, folder=None):
    """One barrier task's part of an epoch.  Rows of slice -1 are test rows and
    come first.  Every task makes the same updates; the first returns them."""
    from pyspark import BarrierTaskContext
    context = BarrierTaskContext.get()
    exchange = _Exchange(context, folder)
    regions = [(k, r) for k, r in enumerate(cols) if r in nets]
    adams = {r: _Adam(flatten(nets[r]), lr, *moments.get(r, ())) for _, r in regions}
    hidden = {r: tuple(len(b) for _, b in nets[r][:-1]) for _, r in regions}
    sums: dict = {}
    rest = _slices(batches, cols)
    number, rows = next(rest, (None, None))

    def measure(rows, split):
        for k, r in regions:
            p = predict(nets[r], np.delete(rows, k, axis=1))
            sums[(r, split)] = sums.get((r, split), 0.0) + _metric_sums(rows[:, k], p, shift[k])
    while number == -1:
        measure(rows, "test")
        number, rows = next(rest, (None, None))
    for s in range(n_slices):
        own = np.zeros((0, len(cols)))
        if number == s:
            own = rows
            measure(own, "train")
            number, rows = next(rest, (None, None))
        parts = [np.array([float(len(own))])]
        for k, r in regions:
            x, y = np.delete(own, k, axis=1), own[:, k]
            layers = unflatten(adams[r].p, len(cols) - 1, hidden[r])
            parts.append(gradient(layers, x, y))
        total = exchange.total(s, np.concatenate(parts))
        at = 1
        for _, r in regions:
            size = len(adams[r].p)
            adams[r].update(total[at:at + size] / total[0])
            at += size
    first = context.partitionId() == 0
    out = [(r, s, *v, None, None) for (r, s), v in sums.items()]
    out += [(r, "state", *[0.0] * len(METRICS), a.state().tolist(), float(a.step)) for r, a in adams.items() if first]
    yield pd.DataFrame(out, columns=["region", "split", *METRICS, "g", "k"])


def train_synchronous(df: DataFrame, cols: Sequence[str], nets: dict, order_by: Sequence[str], max_epochs: int,
                      lr: float = LEARNING_RATE, split_col: str = "split", batch_rows: int = BATCH_ROWS,
                      tol: float = 0.0, patience: int = 3, tasks: int | None = None):
    """As ``train``, but as one sequence of updates: the train rows in the order
    of ``order_by`` (a total order) are cut into slices of ``batch_rows`` rows
    and each slice gives one Adam update of every net.

    ``tasks`` barrier tasks (at most the cores there are; by default up to
    ``SYNC_TASKS``) hold an even share of each slice and exchange gradients,
    through files below the shared checkpoint folder if that is mounted; a
    lost task repeats the epoch.  Rows are numbered and dealt out once."""
    import os
    import shutil
    import uuid

    from pyspark import StorageLevel

    from voxelframe.operators.ordinal import add_time_ordinal
    from voxelframe.session import mounted_folder, table_path
    cols, order_by = list(cols), list(order_by)
    sc = df.sparkSession.sparkContext
    hidden = {r: tuple(len(b) for _, b in layers[:-1]) for r, layers in nets.items()}
    tasks = min(tasks or SYNC_TASKS, sc.defaultParallelism)
    shift = _shift(df, cols)
    shared = mounted_folder(df.sparkSession, table_path(df.sparkSession, f"gradients_{uuid.uuid4().hex}"))
    if shared:
        os.makedirs(shared)
    is_train = F.coalesce(F.col(split_col) == "train", F.lit(False))
    numbered = add_time_ordinal(df.filter(is_train).select(*dict.fromkeys([*cols, *order_by])), [], order_by[0],
                                order_by[1:], "_nth")
    place = F.pmod(F.col("_nth"), F.lit(tasks))
    train_rows = numbered.select(*cols, F.floor(F.col("_nth") / batch_rows).alias("_slice"), place.alias("_task"))
    test_rows = df.filter(~is_train).select(*cols, F.lit(-1).cast("bigint").alias("_slice"),
                                            F.pmod(F.xxhash64(*order_by), F.lit(tasks)).cast("bigint").alias("_task"))
    # a range partitioning would give one task two shares: its bounds are sampled
    data = (train_rows.unionAll(test_rows).repartitionById(tasks, F.col("_task").cast("int")).sortWithinPartitions("_slice")
            .select(*cols, "_slice").persist(StorageLevel.MEMORY_AND_DISK))
    schema = METRIC_SCHEMA + ", g array<double>, k double"
    try:
        last = data.agg(F.max("_slice")).first()[0]
        n_slices = 0 if last is None else last + 1

        def one_epoch(nets, moments):
            sent = sc.broadcast((nets, moments))

            def run(it):
                return _sync_epoch(it, *sent.value, cols, shift, lr, n_slices, shared)
            found = data.mapInPandas(run, schema, barrier=True).collect()
            sent.unpersist()
            rows: dict = {}
            after, moved = dict(nets), {}
            for r in found:
                if r["split"] == "state":
                    p, m, v = np.split(np.asarray(r["g"]), 3)
                    after[r["region"]], moved[r["region"]] = unflatten(p, len(cols) - 1, hidden[r["region"]]), ((m, v), int(r["k"]))
                    continue
                total = rows.setdefault((r["region"], r["split"]), dict.fromkeys(METRICS, 0.0))
                for m in METRICS:
                    total[m] += r[m]
            return rows, after, moved
        return _fit(nets, max_epochs, tol, patience, one_epoch)
    finally:
        data.unpersist()
        if shared:
            shutil.rmtree(shared, ignore_errors=True)

"""Statistics and model-scoring queries: describe, metrics, scalers,
covariance, confounds, variance selection, smoothing, formulas, fan-out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from voxelframe.functions.numeric import r6, sql_draw, sql_r6
from voxelframe.operators import aggregates, formula, linear, metrics, smooth
from voxelframe.plans.registry import query
from voxelframe.plans.stand_ins import MEN_SEGMENT, REGION_COLS, SERIES_SQL, series
from voxelframe.tables import table, small_table

TRAIN_BEFORE = "1999-01-01"


# ------------------------------------------------------------- describe
def _describe_sql(cols):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, {sql_r6(f'avg({c})')} AS mean, "
            f"{sql_r6(f'stddev_samp({c})')} AS std, {sql_r6(f'CAST(min({c}) AS DOUBLE)')} AS min, "
            f"{sql_r6(f'quantile_cont({c}, 0.25)')} AS q25, {sql_r6(f'quantile_cont({c}, 0.5)')} AS q50, "
            f"{sql_r6(f'quantile_cont({c}, 0.75)')} AS q75, {sql_r6(f'CAST(max({c}) AS DOUBLE)')} AS max "
            f"FROM lineitem")
    return " UNION ALL ".join(parts)


@query("describe_table", _describe_sql(REGION_COLS))
def describe_table(spark, sf_dir):
    """count / mean / std / min / quartiles / max per column, quartiles exact."""
    return aggregates.describe(table(spark, sf_dir, "lineitem"), REGION_COLS)


# ------------------------------------------------------------- metrics
_PRED_SQL = """SELECT l_returnflag AS region, l_linestatus, l_suppkey, l_shipdate, l_orderkey,
  l_extendedprice / 1000.0 AS y, p_retailprice * l_quantity / 1000.0 AS p
  FROM lineitem JOIN part ON p_partkey = l_partkey"""


def _r2_sql(y, p, den):
    sse = f"sum(({y} - {p}) * ({y} - {p}))"
    sst = f"(var_pop({den}) * count({den}))"
    return f"(CASE WHEN {sst} > 0 THEN 1 - {sse} / {sst} WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END)"


def predictions(spark, sf_dir):
    """Truth y (price, thousands) and a prediction p (list price x quantity)."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return li.join(pa, "l_partkey").select(
        F.col("l_returnflag").alias("region"), "l_linestatus", "l_suppkey", "l_shipdate", "l_orderkey",
        (F.col("l_extendedprice") / 1000.0).alias("y"),
        (F.col("p_retailprice") * F.col("l_quantity") / 1000.0).alias("p"))


@query("regr_metrics", f"""WITH d AS ({_PRED_SQL})
SELECT region, count(*) AS n, {sql_r6(_r2_sql('y', 'p', 'y'))} AS r2,
  {sql_r6('avg((y - p) * (y - p))')} AS mse, {sql_r6('avg(abs(y - p))')} AS mae FROM d GROUP BY region""")
def regr_metrics(spark, sf_dir):
    m = metrics.regression_metrics(predictions(spark, sf_dir), ["region"], "y", "p")
    return m.select("region", "n", r6(F.col("r2")).alias("r2"), r6(F.col("mse")).alias("mse"),
                    r6(F.col("mae")).alias("mae"))


@query("regr_metrics_swapped", f"""WITH d AS ({_PRED_SQL})
SELECT region, count(*) AS n, {sql_r6(_r2_sql('y', 'p', 'p'))} AS r2 FROM d GROUP BY region""")
def regr_metrics_swapped(spark, sf_dir):
    """R² with the arguments swapped (total variance of the predictions)."""
    m = metrics.regression_metrics(predictions(spark, sf_dir), ["region"], "y", "p", denominator="prediction")
    return m.select("region", "n", r6(F.col("r2")).alias("r2"))


def _metrics_sql(keys, y, p):
    """All metrics over the rows that have both values."""
    return (f"{keys}, count(*) AS n, {sql_r6(_r2_sql(y, p, y))} AS r2, {sql_r6(_r2_sql(y, p, p))} AS r2_swapped, "
            f"{sql_r6(f'avg(({y} - {p}) * ({y} - {p}))')} AS mse, {sql_r6(f'avg(abs({y} - {p}))')} AS mae")


@query("regr_metrics_gaps", f"""WITH d AS ({_PRED_SQL}),
g AS (SELECT region, CASE WHEN l_orderkey % 7 <> 0 THEN y END AS y, CASE WHEN l_orderkey % 5 <> 0 THEN p END AS p FROM d)
SELECT {_metrics_sql("region", "y", "p")} FROM g WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY region""")
def regr_metrics_gaps(spark, sf_dir):
    """Metrics where some truths and some predictions are missing: every
    figure is over the rows that have both."""
    d = predictions(spark, sf_dir)
    d = d.select("region", F.when(F.col("l_orderkey") % 7 != 0, F.col("y")).alias("y"),
                 F.when(F.col("l_orderkey") % 5 != 0, F.col("p")).alias("p"))
    swapped = metrics.metric_columns("y", "p", denominator="prediction")[1].alias("r2_swapped")
    m = d.groupBy("region").agg(*metrics.metric_columns("y", "p"), swapped)
    return m.select("region", "n", *[r6(F.col(c)).alias(c) for c in ("r2", "r2_swapped", "mse", "mae")])


@query("score_matrix", f"""WITH d AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{TRAIN_BEFORE}' THEN 'train' ELSE 'test' END AS split FROM ({_PRED_SQL}))
SELECT region,
  round_even({_r2_sql("CASE WHEN split = 'train' THEN y END", 'p', "CASE WHEN split = 'train' THEN y END")}, 2) AS r2_train,
  round_even({_r2_sql("CASE WHEN split = 'test' THEN y END", 'p', "CASE WHEN split = 'test' THEN y END")}, 2) AS r2_test,
  round_even(avg(abs(y - p)) FILTER (WHERE split = 'train'), 2) AS mae_train,
  round_even(avg(abs(y - p)) FILTER (WHERE split = 'test'), 2) AS mae_test
FROM d GROUP BY region""")
def score_matrix(spark, sf_dir):
    """[r2_train, r2_test, mae_train, mae_test] per region, half-even to 2 digits."""
    d = predictions(spark, sf_dir).withColumn(
        "split", F.when(F.col("l_shipdate") < F.lit(TRAIN_BEFORE).cast("timestamp_ntz"), "train").otherwise("test"))
    return metrics.score_matrix(d, ["region"], "split", "y", "p", digits=2)


def _history(spark, sf_dir):
    d = predictions(spark, sf_dir).withColumn(
        "epoch", ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1).cast("int"))
    tr = F.col("l_linestatus") == "F"
    te = ~tr
    cols = []
    for name, cond in (("train", tr), ("test", te)):
        y = F.when(cond, F.col("y"))
        e = F.when(cond, F.col("y") - F.col("p"))
        sse = F.sum(e * e)
        sst = F.var_pop(y) * F.count(y)
        cols += [metrics._r2(sse, sst).alias(f"r2_{name}"), F.avg(e * e).alias(f"mse_{name}")]
    return d.groupBy("region", "epoch").agg(*cols)


_HIST_SQL = f"""WITH d AS (SELECT *, CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS INTEGER) AS epoch FROM ({_PRED_SQL})),
h AS (SELECT region, epoch,
  {_r2_sql("CASE WHEN l_linestatus = 'F' THEN y END", "CASE WHEN l_linestatus = 'F' THEN p END", "CASE WHEN l_linestatus = 'F' THEN y END")} AS r2_train,
  avg(CASE WHEN l_linestatus = 'F' THEN (y - p) * (y - p) END) AS mse_train,
  {_r2_sql("CASE WHEN l_linestatus <> 'F' THEN y END", "CASE WHEN l_linestatus <> 'F' THEN p END", "CASE WHEN l_linestatus <> 'F' THEN y END")} AS r2_test,
  avg(CASE WHEN l_linestatus <> 'F' THEN (y - p) * (y - p) END) AS mse_test
  FROM d GROUP BY region, epoch)"""


@query("metric_history_thin", _HIST_SQL + f"""
SELECT region, epoch, {sql_r6('r2_train')} AS r2_train, {sql_r6('r2_test')} AS r2_test,
  {sql_r6('mse_train')} AS mse_train, {sql_r6('mse_test')} AS mse_test FROM h WHERE epoch % 12 = 0""")
def metric_history_thin(spark, sf_dir):
    """Per-epoch metric history (epoch = month of shipment), printed every 12th."""
    h = metrics.thin(_history(spark, sf_dir), "epoch", 12)
    return h.select("region", "epoch", *[r6(F.col(c)).alias(c)
                                         for c in ("r2_train", "r2_test", "mse_train", "mse_test")])


FLAG_THRESHOLD = -9.5


@query("flag_regions", f"""WITH d AS ({_PRED_SQL}),
s AS (SELECT l_suppkey AS region, {_r2_sql('y', 'p', 'p')} AS r2 FROM d GROUP BY l_suppkey)
SELECT region, {sql_r6('r2')} AS r2 FROM s WHERE r2 < {FLAG_THRESHOLD}""")
def flag_regions(spark, sf_dir):
    """Regions (suppliers) whose transfer R² falls below the threshold."""
    d = predictions(spark, sf_dir).withColumn("region", F.col("l_suppkey"))
    s = metrics.regression_metrics(d, ["region"], "y", "p", denominator="prediction")
    return metrics.flag(s, "r2", FLAG_THRESHOLD).select("region", r6(F.col("r2")).alias("r2"))


@query("cross_cohort_r2", f"""WITH d AS (SELECT l_returnflag AS region, l_extendedprice / 1000.0 AS y,
    p_retailprice * l_quantity / 1000.0 AS x,
    CASE WHEN c_mktsegment = '{MEN_SEGMENT}' THEN 'men' ELSE 'women' END AS cohort
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey),
f AS (SELECT region, coalesce(regr_slope(y, x), 0) AS b, avg(y) - coalesce(regr_slope(y, x), 0) * avg(x) AS a
      FROM d WHERE cohort = 'men' GROUP BY region),
s AS (SELECT d.region, y, a + b * x AS p FROM d JOIN f USING (region) WHERE cohort = 'women')
SELECT region, round_even({_r2_sql('y', 'p', 'p')}, 4) AS r2 FROM s GROUP BY region""")
def cross_cohort_r2(spark, sf_dir):
    """Fit on one cohort, score on the other, per region (linear model)."""
    from voxelframe.operators.joins import label_lookup, route
    pr = predictions(spark, sf_dir).withColumnRenamed("p", "x")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    d = label_lookup(pr.join(o, "l_orderkey"), c, "o_custkey").withColumn(
        "cohort", route(F.col("c_mktsegment"), MEN_SEGMENT, "men", "women"))
    fit = d.filter(F.col("cohort") == "men").groupBy("region").agg(
        F.covar_pop("x", "y").alias("cv"), F.var_pop("x").alias("vx"), F.avg("x").alias("mx"),
        F.avg("y").alias("my"))
    b = F.when(F.col("vx") > 0, F.col("cv") / F.col("vx")).otherwise(F.lit(0.0))
    fit = fit.select("region", b.alias("b"), (F.col("my") - b * F.col("mx")).alias("a"))
    scored = d.filter(F.col("cohort") == "women").join(fit, "region").withColumn(
        "p", F.col("a") + F.col("b") * F.col("x"))
    m = metrics.regression_metrics(scored, ["region"], "y", "p", denominator="prediction")
    return m.select("region", F.bround(F.col("r2"), 4).alias("r2"))


# ------------------------------------------------------------- scaler
@query("scale_features", f"""WITH s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in REGION_COLS)}
  FROM lineitem WHERE l_shipdate < TIMESTAMP '{TRAIN_BEFORE}')
SELECT l_orderkey, l_linenumber, {', '.join(sql_r6(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END') + f' AS z_{c}' for c in REGION_COLS)}
FROM lineitem, s""")
def scale_features(spark, sf_dir):
    """Standardise every row with statistics of the training rows only."""
    li = table(spark, sf_dir, "lineitem")
    stats = linear.fit_scaler(li.filter(F.col("l_shipdate") < F.lit(TRAIN_BEFORE).cast("timestamp_ntz")),
                              REGION_COLS)
    z = linear.apply_scaler(li, stats, prefix="z_")
    return z.select("l_orderkey", "l_linenumber", *[r6(F.col(f"z_{c}")).alias(f"z_{c}") for c in REGION_COLS])


# ------------------------------------------------------------- covariance
@query("gram_corr", " UNION ALL ".join(
    f"SELECT '{a}' AS ci, '{b}' AS cj, {sql_r6(f'covar_pop({a}, {b})', 4)} AS cov, {sql_r6(f'corr({a}, {b})')} AS corr FROM lineitem"
    for i, a in enumerate(REGION_COLS) for b in REGION_COLS[i + 1:]))
def gram_corr(spark, sf_dir):
    p = linear.covariance_pairs(table(spark, sf_dir, "lineitem"), REGION_COLS)
    return p.select("ci", "cj", r6(F.col("cov"), 4).alias("cov"), r6(F.col("corr")).alias("corr"))


_EMB_LONG = ("SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, "
             "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings")


@query("embedding_corr", f"""WITH e AS ({_EMB_LONG})
SELECT a.pos AS i, b.pos AS j, {sql_r6('covar_pop(a.v, b.v)', 8)} AS cov, {sql_r6('corr(a.v, b.v)')} AS corr
FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.pos < b.pos GROUP BY a.pos, b.pos""")
def embedding_corr(spark, sf_dir):
    """Covariance / correlation of all 64 dimensions from one shifted Gram pass."""
    emb = table(spark, sf_dir, "embeddings").select("embedding")
    emb = emb.filter(F.col("embedding").isNotNull())
    some = emb.first()
    if some is None:
        return spark.createDataFrame([], "i int, j int, cov double, corr double")
    first = np.asarray(some["embedding"], dtype=np.float64)   # dimension and shift
    dim = len(first)
    n, _, m2 = linear.centred_gram(emb, "embedding", dim, shift=first)
    cov, corr = linear.covariance_from_gram(n, m2)
    iu, ju = np.triu_indices(dim, k=1)
    rows = [(int(i), int(j), float(cov[i, j]), float(corr[i, j])) for i, j in zip(iu, ju)]
    df = small_table(spark, rows, "i int, j int, cov double, corr double")
    return df.select("i", "j", r6(F.col("cov"), 8).alias("cov"), r6(F.col("corr")).alias("corr"))


# ------------------------------------------------------------- confounds
@query("one_confound_residual", f"""WITH o AS ({SERIES_SQL}),
c AS (SELECT user_id, t, CAST(json_extract(props, '$.k') AS DOUBLE) AS c0 FROM o),
r AS (SELECT user_id, t, value FROM o),
j AS (SELECT r.user_id, r.t, r.value, c.c0 FROM r JOIN c USING (user_id, t))
SELECT user_id, t, {sql_r6("value - (avg(value) OVER (PARTITION BY user_id) + coalesce(regr_slope(value, c0) OVER (PARTITION BY user_id), 0) * (c0 - avg(c0) OVER (PARTITION BY user_id)))")} AS resid FROM j""")
def one_confound_residual(spark, sf_dir):
    """Region signal with one confound regressed out per scan.  Here the
    confound is a property of the same time point, so it is read with the
    series (no alignment join; ``extract_regions`` aligns a separate
    confound table on (scan, t))."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value", "props"))
    j = s.select("user_id", "t", "value", F.get_json_object("props", "$.k").cast("double").alias("c0"))
    r = linear.single_confound_residual(j, ["user_id"], "value", "c0")
    return r.select("user_id", "t", r6(F.col("value")).alias("resid"))


def _confound_multi_sql():
    """Gram-Schmidt over the complete rows: every confound is orthogonalised
    on the ones before, then the value on each of them."""
    p = "OVER (PARTITION BY user_id)"
    zs = ["c0", "c1", "c2", "c3"]
    steps = [f"""base AS (SELECT user_id, t, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
    CAST(json_extract(props, '$.k') AS DOUBLE) AS c0, CASE WHEN event_id % 11 <> 3 THEN CAST(hour(ts) AS DOUBLE) END AS c1,
    minute(ts) / 60.0 AS c2, CAST(dayofweek(ts) + 1 AS DOUBLE) AS c3 FROM ({SERIES_SQL})),
s0 AS (SELECT user_id, t, {", ".join(f"{c} - avg({c}) {p} AS {c}" for c in ["value", *zs])} FROM base
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in ["value", *zs])})"""]
    for i, z in enumerate(zs):
        rest = ["value", *zs[i + 1:]]
        cut = ", ".join(f"{c} - coalesce(sum({c} * {z}) {p} / nullif(sum({z} * {z}) {p}, 0), 0) * {z} AS {c}" for c in rest)
        steps.append(f"s{i + 1} AS (SELECT user_id, t, {cut} FROM s{i})")
    return ("WITH " + ",\n".join(steps) + f"""
SELECT base.user_id, base.t, {sql_r6("s4.value")} AS resid FROM base LEFT JOIN s4 USING (user_id, t)""")


@query("confound_residual_multi", _confound_multi_sql())
def confound_residual_multi(spark, sf_dir):
    """Residual on four confounds plus intercept per scan, over the rows
    where the value and all confounds exist (some of each are missing)."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value", "props"))
    d = s.select("user_id", "t", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
                 F.get_json_object("props", "$.k").cast("double").alias("c0"),
                 F.when(F.col("event_id") % 11 != 3, F.hour("ts").cast("double")).alias("c1"),
                 (F.minute("ts") / 60.0).alias("c2"),
                 F.dayofweek("ts").cast("double").alias("c3"))
    r = linear.confound_residuals(d, ["user_id"], ["value"], ["c0", "c1", "c2", "c3"])
    return r.select("user_id", "t", r6(F.col("value")).alias("resid"))


WIDE_COLS = 64


@query("gram_by_wide", f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 17 <> 0)
SELECT label, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, count(*) AS n, {sql_r6("sum(v[i + 1] * v[j + 1])", 9)} AS g
FROM e, range({WIDE_COLS}) a(i), range({WIDE_COLS}) b(j) WHERE i <= j GROUP BY ALL""")
def gram_by_wide(spark, sf_dir):
    """Cross products of 64 columns per group; rows with a missing value
    (here every 17th) are left out of all of them."""
    e = table(spark, sf_dir, "embeddings")
    cols = [f"x{i}" for i in range(WIDE_COLS)]
    wide = e.select("label", *[F.when((F.col("vec_id") % 17 != 0) | F.lit(i != 5), F.col("embedding")[i].cast("double"))
                               .alias(c) for i, c in enumerate(cols)])
    grams = linear.gram_by(wide, "label", cols)
    rows = [(k, i, j, n, float(g[i, j])) for k, (n, g) in grams.items() for i in range(WIDE_COLS) for j in range(i, WIDE_COLS)]
    return small_table(spark, rows, "label int, i int, j int, n bigint, g double").withColumn("g", r6(F.col("g"), 9))


# ------------------------------------------------------------- variance, smoothing
def _emb_long(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("pos", "v")) \
            .withColumn("v", F.col("v").cast("double"))


@query("var_top_features", f"""WITH e AS ({_EMB_LONG}),
v AS (SELECT label, pos, var_pop(v) AS var FROM e GROUP BY 1, 2),
t AS (SELECT label, quantile_cont(var, 0.98) AS thr FROM v GROUP BY 1)
SELECT v.label, v.pos, {sql_r6('var', 9)} AS var FROM v JOIN t USING (label) WHERE var > thr""")
def var_top_features(spark, sf_dir):
    """Per group (label), the positions whose variance is above the 98th
    percentile -- the voxel selection behind high-variance confounds."""
    hv = aggregates.high_variance_features(_emb_long(spark, sf_dir), ["label"], "pos", "v", 2.0)
    return hv.select("label", "pos", r6(F.col("var"), 9).alias("var"))


KERNEL = smooth.gaussian_kernel(fwhm=2.0, radius=2)
_SMOOTH_SQL = f"""WITH e AS ({_EMB_LONG}),
k AS (SELECT * FROM (VALUES {', '.join(f'({o}, CAST({w!r} AS DOUBLE))' for o, w in KERNEL)}) k(o, w))
SELECT a.vec_id, a.pos, {sql_r6('sum(k.w * b.v) / sum(k.w)')} AS s
FROM e a JOIN k ON TRUE JOIN e b ON b.vec_id = a.vec_id AND b.pos = a.pos + k.o
GROUP BY a.vec_id, a.pos"""


@query("neighbour_smooth", _SMOOTH_SQL)
def neighbour_smooth(spark, sf_dir):
    """Gaussian smoothing along the voxel axis of each vector (array form,
    no shuffle)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    sm = smooth.smooth_array(e, "embedding", KERNEL, "sm")
    return sm.select("vec_id", F.posexplode("sm").alias("pos", "s")).select(
        "vec_id", "pos", r6(F.col("s")).alias("s"))


@query("neighbour_smooth_long", _SMOOTH_SQL)
def neighbour_smooth_long(spark, sf_dir):
    """Same smoothing on long voxel rows (bounded fan-out + grouped sum)."""
    lg = _emb_long(spark, sf_dir).select("vec_id", "pos", "v")
    sm = smooth.smooth_long(lg, ["vec_id"], "pos", "v", KERNEL, "s")
    return sm.select("vec_id", "pos", r6(F.col("s")).alias("s"))


KERNEL_LINE = smooth.gaussian_kernel(fwhm=2.0, radius=1)
KERNEL_3D = smooth.gaussian_kernel_3d(fwhm=2.0, radius=1)
_CUBE = "SELECT vec_id, label, pos % 4 AS x, pos // 4 % 4 AS y, pos // 16 AS z, v FROM e WHERE (pos + vec_id) % 9 <> 0"


@query("volume_smooth", f"""WITH e AS ({_EMB_LONG}), c AS ({_CUBE}),
k(dx, dy, dz, w) AS (VALUES {", ".join(f"({a}, {b}, {c}, {w!r}::DOUBLE)" for a, b, c, w in KERNEL_3D)})
SELECT a.vec_id, CAST(a.x AS INTEGER) AS x, CAST(a.y AS INTEGER) AS y, CAST(a.z AS INTEGER) AS z,
  {sql_r6("sum(w * b.v) / sum(w)")} AS s
FROM c a JOIN k ON true JOIN c b ON b.vec_id = a.vec_id AND b.x = a.x + dx AND b.y = a.y + dy AND b.z = a.z + dz GROUP BY ALL""")
def volume_smooth(spark, sf_dir):
    """Each vector as a 4 x 4 x 4 volume with some voxels missing, smoothed
    with a 3 x 3 x 3 kernel, one axis after the other."""
    p = F.col("pos")
    vox = _emb_long(spark, sf_dir).filter((p + F.col("vec_id")) % 9 != 0).select(
        "vec_id", (p % 4).alias("x"), F.floor(p / 4).cast("int") % 4, F.floor(p / 16).cast("int").alias("z"), "v")
    vox = vox.toDF("vec_id", "x", "y", "z", "v")
    out = smooth.smooth_volume(vox, ["vec_id"], "v", KERNEL_LINE, "s")
    return out.select("vec_id", "x", "y", "z", r6(F.col("s")).alias("s"))


# ------------------------------------------------------------- formulas
# Fixed formula table over the lineitem region matrix: id -> (target, tree)
FORMULAS = {
    1: ("l_tax", ("add", ("mul", "l_discount", 0.5), 0.01)),
    2: ("l_tax", ("div", "l_discount", ("add", "l_quantity", 1.0))),
    3: ("l_tax", ("sub", ("cos", "l_discount"), 0.95)),
    4: ("l_tax", ("mul", ("sin", ("mul", "l_quantity", 0.02)), 0.05)),
    5: ("l_discount", ("div", "l_tax", "l_discount")),
    6: ("l_discount", ("add", ("mul", "l_tax", 0.8), 0.02)),
    7: ("l_discount", ("sub", ("mul", "l_extendedprice", 1e-06), ("div", "l_quantity", 1000.0))),
    8: ("l_discount", ("mul", ("cos", "l_tax"), 0.05)),
}
PARSIMONY = 0.0005


# 9 digits: formulas of 2-decimal columns can be exact 8-decimal values,
# which would sit on a rounding tie at 6 digits
@query("formula_eval", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{sql_r6(formula.render(t, 'duckdb'), 9)} AS f{i}" for i, (_, t) in FORMULAS.items()) + " FROM lineitem")
def formula_eval(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    ev = formula.evaluate(li, {i: t for i, (_, t) in FORMULAS.items()}, ["l_orderkey", "l_linenumber"])
    return ev.select("l_orderkey", "l_linenumber", *[r6(F.col(f"f{i}"), 9).alias(f"f{i}") for i in FORMULAS])


_FIT_SQL = "WITH m AS (" + " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS formula_id, '{y}' AS region, count(*) AS n, "
    f"avg(({formula.render(t, 'duckdb')} - {y}) * ({formula.render(t, 'duckdb')} - {y})) AS mse, "
    f"CAST({formula.length(t)} AS INTEGER) AS length FROM lineitem" for i, (y, t) in FORMULAS.items()) + ")"


@query("formula_fitness", _FIT_SQL + f"""
SELECT formula_id, region, n, {sql_r6('mse', 9)} AS mse, length, {sql_r6(f'mse + {PARSIMONY} * length', 9)} AS fitness FROM m""")
def formula_fitness(spark, sf_dir):
    """MSE + parsimony x length of every formula against its target, one pass."""
    fit = formula.fitness(table(spark, sf_dir, "lineitem"), {i: t for i, (_, t) in FORMULAS.items()},
                          {i: y for i, (y, _) in FORMULAS.items()}, parsimony=PARSIMONY)
    return fit.select("formula_id", "region", "n", r6(F.col("mse"), 9).alias("mse"), "length",
                      r6(F.col("fitness"), 9).alias("fitness"))


@query("best_formula", _FIT_SQL + f"""
SELECT region, arg_min(formula_id, mse + {PARSIMONY} * length) AS formula_id,
  {sql_r6(f'min(mse + {PARSIMONY} * length)', 9)} AS fitness FROM m GROUP BY region""")
def best_formula(spark, sf_dir):
    fit = formula.fitness(table(spark, sf_dir, "lineitem"), {i: t for i, (_, t) in FORMULAS.items()},
                          {i: y for i, (y, _) in FORMULAS.items()}, parsimony=PARSIMONY)
    b = formula.best_per_region(fit)
    return b.select("region", "formula_id", r6(F.col("fitness"), 9).alias("fitness"))


# ------------------------------------------------------------- fan-out
@query("grid_fanout", """
WITH jobs AS (SELECT CAST(range + 1 AS BIGINT) AS job_id FROM range((SELECT count(*) FROM part))),
params AS (SELECT p_partkey + 1 AS job_id, p_size, p_brand FROM part)
SELECT j.job_id, CAST(pr.p_size AS VARCHAR) AS size, pr.p_brand AS brand,
  count(l_orderkey) AS n_lines, sum(l_quantity) AS qty
FROM jobs j JOIN params pr USING (job_id) LEFT JOIN lineitem ON l_partkey = j.job_id - 1
GROUP BY 1, 2, 3""")
def grid_fanout(spark, sf_dir):
    """One run per job id (1-based): its hyper-parameter set by job number
    and its own data rows (the lines of that part)."""
    from voxelframe.plans.fanout import grid_runs
    return grid_runs(spark, sf_dir)


@query("hv_confounds")
def hv_confounds(spark, sf_dir):
    """Top-5 time courses of the most variable voxels per scan (scan =
    label group, voxel = position, time = vector id)."""
    from voxelframe.operators.confounds import high_variance_confounds
    long = _emb_long(spark, sf_dir).select("label", "pos", F.col("vec_id").alias("t"), "v")
    # a tenth of the 64 positions: more than the five components asked for
    c = high_variance_confounds(long, ["label"], "pos", "t", "v", n_confounds=5, percentile=10.0)
    return c.select("label", "t", *[r6(F.col(f"c{i}")).alias(f"c{i}") for i in range(5)])


_SLOTS, _CONTESTANTS = 8, 3


@query("tournament_winners", _FIT_SQL + f""", f AS (SELECT formula_id, mse + {PARSIMONY} * length AS fitness FROM m),
p AS (SELECT *, row_number() OVER (ORDER BY formula_id) - 1 AS pos, count(*) OVER () AS n FROM f),
d AS (SELECT s AS slot, {sql_draw(0, 's', 'c')} % {len(FORMULAS)} AS pos FROM range({_SLOTS}) a(s), range({_CONTESTANTS}) b(c))
SELECT slot, formula_id, {sql_r6('fitness', 9)} AS fitness FROM (
  SELECT slot, formula_id, fitness, row_number() OVER (PARTITION BY slot ORDER BY fitness, formula_id) AS r
  FROM d JOIN p USING (pos)) WHERE r = 1""")
def tournament_winners(spark, sf_dir):
    """One round of tournament selection (8 slots, 3 contestants each) over
    the fitness of the formula table on lineitem."""
    fit = formula.fitness(table(spark, sf_dir, "lineitem"), {i: t for i, (_, t) in FORMULAS.items()},
                          {i: y for i, (y, _) in FORMULAS.items()}, parsimony=PARSIMONY)
    won = formula.tournament_select(fit, n_slots=_SLOTS, k=_CONTESTANTS, seed=0)
    return won.withColumn("fitness", r6(F.col("fitness"), 9))

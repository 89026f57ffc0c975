"""Extraction, quarantine, file round trip, and the iterative / randomised
modelling queries (linear fits for all targets, boosted trees, nets,
formula search).  The last group has no oracle SQL; tests check them."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from voxelframe.functions.numeric import DRAW_BITS, r6, sql_draw, sql_r6
from voxelframe.operators import formula, linear, metrics, net, trees
from voxelframe.operators.joins import label_lookup, route
from voxelframe.operators.split import hash_split
from voxelframe.plans.extract import extract_regions, quarantine
from voxelframe.plans.registry import query
from voxelframe.plans.stand_ins import MEN_SEGMENT, REGION_COLS, SERIES_SQL, series
from voxelframe.session import table_path
from voxelframe.sources import files
from voxelframe.tables import table, small_table

TYPES = ["click", "error", "purchase", "signup", "view"]


# ------------------------------------------------------------- extraction
def _extract_sql():
    xs = [f"x{i}" for i in range(len(TYPES))]
    piv = ", ".join(f"avg(value) FILTER (WHERE event_type = '{t}') AS x{i}" for i, t in enumerate(TYPES))
    p = "OVER (PARTITION BY user_id)"
    resid = ", ".join(
        f"{x} - (regr_avgy({x}, c0) {p} + coalesce(regr_slope({x}, c0) {p}, 0) * (c0 - regr_avgx({x}, c0) {p})) AS {x}"
        for x in xs)
    z = ", ".join(
        sql_r6(f"({x} - avg({x}) {p}) / CASE WHEN coalesce(stddev_pop({x}) {p}, 0) <= 1e-9 THEN 1.0 ELSE stddev_pop({x}) {p} END")
        + f" AS {x}" for x in xs)
    return f"""WITH v AS (SELECT user_id, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS t,
    event_type, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
w AS (SELECT user_id, t, {piv} FROM v GROUP BY 1, 2),
c AS (SELECT user_id, t, avg(k) AS c0 FROM v GROUP BY 1, 2),
j AS (SELECT w.*, c.c0 FROM w JOIN c USING (user_id, t)),
r AS (SELECT user_id, t, {resid} FROM j)
SELECT user_id, t, {z} FROM r"""


@query("extract_regions", _extract_sql())
def extract_regions_q(spark, sf_dir):
    """Voxels -> region means -> confound regression -> z-score per scan.
    (scan = user, voxel = event, region = event type, t = day, confound =
    the day's mean of the event property k)."""
    from voxelframe.operators.aggregates import distinct_values, label_table
    ev = table(spark, sf_dir, "events")
    types = distinct_values(ev, "event_type")          # bounded label list
    atlas = label_table(spark, types, "event_type")
    labels = list(range(1, len(types) + 1))
    v = ev.select("user_id", "event_type", "value", "props",
                  F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("t"))
    conf = v.groupBy("user_id", "t").agg(
        F.avg(F.get_json_object("props", "$.k").cast("double")).alias("c0"))
    out = extract_regions(v.drop("props"), atlas, labels, keys=["user_id"], t="t",
                          confounds=conf, confound_cols=["c0"], standardize=True)
    return out.select("user_id", "t", *[r6(F.col(f"x{i}")).alias(f"x{i}") for i in range(len(labels))])


MIN_LENGTH = 60


@query("quarantine", f"""SELECT user_id, count(*) AS n,
  CASE WHEN count(*) < {MIN_LENGTH} THEN 'error' WHEN stddev_pop(value) = 0 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN count(*) < {MIN_LENGTH} THEN 'series too short' WHEN stddev_pop(value) = 0 THEN 'constant series' END AS error
FROM events GROUP BY user_id""")
def quarantine_q(spark, sf_dir):
    """Per-scan status instead of try/except-and-continue: good scans and
    quarantined scans (with the reason) from one pass."""
    ev = table(spark, sf_dir, "events")
    st = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("value").alias("sd"))
    good, bad = quarantine(st, {"series too short": F.col("n") < MIN_LENGTH,
                                "constant series": F.col("sd") == 0})
    return good.unionByName(bad).select("user_id", "n", "status", "error")


@query("csv_roundtrip", f"WITH o AS ({SERIES_SQL}) SELECT user_id, t, value FROM o")
def csv_roundtrip(spark, sf_dir):
    """Write one CSV per scan (rows in time order, no index), read the
    directory back with provenance and rebuild the time ordinal from the
    file order."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    out = table_path(spark, f"csv_roundtrip_{uuid.uuid4().hex}")
    files.write_per_scan(s.select("user_id", "t", "value"), out, "user_id")
    back = files.read_region_csvs(spark, out, schema="value double, user_id bigint")
    return back.select("user_id", "t", "value")


@query("hash_split", f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN {sql_draw(0, 'l_orderkey', 'l_linenumber')} < {int(0.3 * (1 << DRAW_BITS))} THEN 'test' ELSE 'train' END AS split
FROM lineitem""")
def hash_split_q(spark, sf_dir):
    """Seeded 70/30 split that does not depend on partitioning."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return hash_split(li, ["l_orderkey", "l_linenumber"], 0.3, seed=0)


# ------------------------------------------------------------- region matrix
TRAIN_BEFORE = "1999-01-01"


def region_matrix(spark, sf_dir, with_cohort: bool = False):
    """lineitem's four numeric columns standardised with training-row
    statistics; split by ship date."""
    li = table(spark, sf_dir, "lineitem")
    train = F.col("l_shipdate") < F.lit(TRAIN_BEFORE).cast("timestamp_ntz")
    stats = linear.fit_scaler(li.filter(train), REGION_COLS)
    d = linear.apply_scaler(li, stats).withColumn(
        "split", F.when(train, "train").otherwise("test"))
    if with_cohort:
        o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        d = label_lookup(d.join(o, "l_orderkey"), c, "o_custkey").withColumn(
            "cohort", route(F.col("c_mktsegment"), MEN_SEGMENT, "men", "women"))
    return d


def _train_gram(d):
    """Means and population covariances of the train rows: one native
    aggregate of stable co-moments."""
    k = len(REGION_COLS)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = d.filter(F.col("split") == "train").agg(
        *[F.avg(c) for c in REGION_COLS], *[F.covar_pop(REGION_COLS[i], REGION_COLS[j]) for i, j in pairs]).first()
    cov = np.zeros((k, k))
    for (i, j), v in zip(pairs, row[k:]):
        cov[i, j] = cov[j, i] = v
    return np.array(row[:k]), cov


LASSO_ALPHA = 0.001


def _lasso_sql(cycles: int = 500):
    """Coordinate descent on the train covariances, one recursion per cycle."""
    cols = REGION_COLS
    tr = f"l_shipdate < TIMESTAMP '{TRAIN_BEFORE}'"
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    z = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}" for c in cols)
    cov = ", ".join(f"covar_pop({a}, {b}) AS v_{a}__{b}" for a in cols for b in cols)
    walks, rows = [], []
    for n, k in enumerate(cols):
        a, b, c = (x for x in cols if x != k)

        def step(i, one, two):
            r = f"(v_{i}__{k} - v_{i}__{one[0]} * {one[1]} - v_{i}__{two[0]} * {two[1]})"
            return f"sign({r}) * greatest(abs({r}) - {LASSO_ALPHA}, 0) / v_{i}__{i}"
        walks.append(f"""w{n}(i, b1, b2, b3) AS (SELECT 0, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE UNION ALL
  SELECT i + 1, n1, n2, {step(c, (a, 'n1'), (b, 'n2'))} FROM (SELECT *, {step(b, (a, 'n1'), (c, 'b3'))} AS n2 FROM (
    SELECT *, {step(a, (b, 'b2'), (c, 'b3'))} AS n1 FROM w{n}, g WHERE i < {cycles})))""")
        rows += [f"SELECT '{k}' AS region, '{x}' AS feature, {sql_r6(f'b{j}')} AS weight FROM w{n} WHERE i = {cycles}"
                 for j, x in enumerate((a, b, c), 1)]
    return (f"WITH RECURSIVE s AS (SELECT {stats} FROM lineitem WHERE {tr}), "
            f"z AS (SELECT {z} FROM lineitem, s WHERE {tr}), g AS MATERIALIZED (SELECT {cov} FROM z), "
            + ", ".join(walks) + " " + " UNION ALL ".join(rows))


@query("lasso_all", _lasso_sql())
def lasso_all(spark, sf_dir):
    """Lasso weights of every region from all the others, from one Gram pass."""
    _, cov = _train_gram(region_matrix(spark, sf_dir))
    w = linear.lasso_all_targets(cov, LASSO_ALPHA)
    rows = [(REGION_COLS[k], REGION_COLS[j], float(w[k, j]))
            for k in range(len(REGION_COLS)) for j in range(len(REGION_COLS)) if j != k]
    return small_table(spark, rows, "region string, feature string, weight double").select(
        "region", "feature", r6(F.col("weight")).alias("weight"))


def _linear_fanout_sql():
    """DuckDB twin of ``linear_fanout``: train statistics, standardised rows,
    train covariances, 3x3 normal equations per target by Cramer's rule."""
    cols = REGION_COLS
    tr = f"l_shipdate < TIMESTAMP '{TRAIN_BEFORE}'"
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    zcols = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}" for c in cols)
    g = ", ".join([f"avg({c}) AS mu_{c}" for c in cols] +
                  [f"covar_pop({a}, {b}) AS v_{a}__{b}" for a in cols for b in cols])

    def v(a, b):
        return f"v_{a}__{b}"

    def det3(m):
        (a, b, c), (d, e, f), (gg, h, i) = m
        return f"(({a})*(({e})*({i})-({f})*({h})) - ({b})*(({d})*({i})-({f})*({gg})) + ({c})*(({d})*({h})-({e})*({gg})))"

    parts = []
    for k in cols:
        o = [c for c in cols if c != k]
        a = [[v(r, c) for c in o] for r in o]
        rhs = [v(r, k) for r in o]
        den = det3(a)
        ws = []
        for i in range(3):
            m = [row[:] for row in a]
            for r in range(3):
                m[r][i] = rhs[r]
            ws.append(f"({det3(m)}) / ({den})")
        pred = f"mu_{k} + " + " + ".join(f"({w}) * ({c} - mu_{c})" for w, c in zip(ws, o))
        sse = f"sum(({k} - ({pred})) * ({k} - ({pred})))"
        sst = f"(var_pop({k}) * count(*))"
        r2 = f"(CASE WHEN {sst} > 0 THEN 1 - {sse} / {sst} WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END)"
        parts.append(f"SELECT '{k}' AS region, split, count(*) AS n, {sql_r6(r2)} AS r2, "
                     f"{sql_r6(f'avg(({k} - ({pred})) * ({k} - ({pred})))')} AS mse, "
                     f"{sql_r6(f'avg(abs({k} - ({pred})))')} AS mae FROM z, g GROUP BY split")
    return (f"WITH s AS (SELECT {stats} FROM lineitem WHERE {tr}), "
            f"z AS (SELECT CASE WHEN {tr} THEN 'train' ELSE 'test' END AS split, {zcols} FROM lineitem, s), "
            f"g AS (SELECT {g} FROM z WHERE split = 'train') " + " UNION ALL ".join(parts))


@query("linear_fanout", _linear_fanout_sql())
def linear_fanout(spark, sf_dir):
    """Every region predicted from the others (least squares from the train
    Gram), scored per split -- one pass for all targets."""
    d = region_matrix(spark, sf_dir)
    mu, cov = _train_gram(d)
    w = linear.ols_all_targets(cov)
    p = linear.predict_all_targets(d, REGION_COLS, mu, w)
    aggs = []
    for c in REGION_COLS:
        aggs.append(F.struct(F.lit(c).alias("region"), *metrics.metric_columns(c, "p_" + c)).alias("m_" + c))
    wide = p.groupBy("split").agg(*aggs)
    long = wide.select("split", F.explode(F.array(*[F.col("m_" + c) for c in REGION_COLS])).alias("m"))
    return long.select("m.region", "split", "m.n", r6(F.col("m.r2")).alias("r2"),
                       r6(F.col("m.mse")).alias("mse"), r6(F.col("m.mae")).alias("mae"))


ROW = ["l_orderkey", "l_linenumber"]


@query("gbt_region")
def gbt_region(spark, sf_dir):
    """Boosted trees for one region, as many as lower the error on held-out
    rows, saved and loaded back; top-50 feature importance table."""
    li = table(spark, sf_dir, "lineitem").select(*REGION_COLS, *ROW).persist()
    try:
        fitted, feats, _ = trees.fit_region(li, REGION_COLS, "l_extendedprice", id_cols=ROW)
    finally:
        li.unpersist()
    path = table_path(spark, f"trees_{uuid.uuid4().hex}")
    trees.save_model(fitted, path)
    model = trees.load_model(path)
    return trees.importance_table(spark, model, feats, "l_extendedprice", top=50)


SPLIT_TREES = 40


@query("gbt_split_counts")
def gbt_split_counts(spark, sf_dir):
    """How often each feature is split on by the trees of one region, counted
    over the nodes of the saved model."""
    li = table(spark, sf_dir, "lineitem").select(*REGION_COLS).persist()
    try:
        fitted, feats, _ = trees.fit_region(li, REGION_COLS, "l_extendedprice", max_iter=SPLIT_TREES)
    finally:
        li.unpersist()
    path = table_path(spark, f"trees_{uuid.uuid4().hex}")
    trees.save_model(fitted, path)
    return trees.split_counts(spark, path, feats, "l_extendedprice").select("region", "feature", "splits", "rows")


def _init_nets(seed: int = 0, hidden=net.HIDDEN):
    rng = np.random.default_rng(seed)
    return {c: net.init_net(rng, len(REGION_COLS) - 1, hidden) for c in REGION_COLS}


# nets small enough to be written out as SQL for the comparison
SQL_HIDDEN = (4, 3, 2)


def _net_score_sql():
    cols = REGION_COLS
    tr = f"l_shipdate < TIMESTAMP '{TRAIN_BEFORE}'"
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    z = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}" for c in cols)
    parts = []
    for k, layers in _init_nets(0, SQL_HIDDEN).items():
        names = [c for c in cols if c != k]
        source = "z"
        for i, (w, b) in enumerate(layers):
            new = []
            for row, bias in zip(w, b):
                e = " + ".join([f"{float(bias)!r}::DOUBLE", *[f"{float(v)!r}::DOUBLE * {n}" for v, n in zip(row, names)]])
                if i < len(layers) - 2:
                    e = f"CASE WHEN {e} > 20 THEN {e} ELSE ln(1 + exp(least({e}, 20))) END"
                new.append(f"tanh({e})" if i == len(layers) - 2 else e)
            names = [f"h{i}_{j}" for j in range(len(new))]
            source = f"(SELECT *, {', '.join(f'{e} AS {n}' for e, n in zip(new, names))} FROM {source})"
        p = names[0]
        parts.append(f"SELECT '{k}' AS region, count(*) AS n, round_even(1 - sum(({k} - {p}) ** 2) / (var_pop({p}) * count(*)), 4) AS r2, "
                     f"{sql_r6(f'avg(({k} - {p}) ** 2)')} AS mse FROM {source}")
    return (f"WITH s AS (SELECT {stats} FROM lineitem WHERE {tr}), "
            f"z AS (SELECT {z} FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey, s "
            f"WHERE c_mktsegment <> '{MEN_SEGMENT}') " + " UNION ALL ".join(parts))


@query("net_score", _net_score_sql())
def net_score(spark, sf_dir):
    """Nets saved for one cohort, loaded back by (cohort, region), scored on
    the other cohort: R² with swapped arguments, 4 digits (half even)."""
    wt = net.weights_table(spark, _init_nets(0, SQL_HIDDEN), "men")
    path = table_path(spark, f"net_weights_{uuid.uuid4().hex}")
    wt.write.mode("overwrite").parquet(path)
    nets = net.nets_from_table(spark.read.parquet(path), "men")
    d = region_matrix(spark, sf_dir, with_cohort=True).filter(F.col("cohort") == "women")
    m = net.score(d, REGION_COLS, nets)
    return m.select("region", "n", F.bround(F.col("r2_swapped"), 4).alias("r2"),
                    r6(F.col("mse")).alias("mse"))


# training ends once no net's train error falls by 2 % in three epochs
NET_RULE = {"max_epochs": 10_000, "tol": 0.02, "patience": 3}


@query("net_train")
def net_train(spark, sf_dir):
    """Every region's net trained slice by slice, one update for each slice of
    all train rows, until its error stops falling; the metric history per epoch."""
    d = region_matrix(spark, sf_dir).select(*REGION_COLS, "split", *ROW)
    _, hist = net.train_synchronous(d, REGION_COLS, _init_nets(0), ROW, **NET_RULE)
    return small_table(spark,
        hist, "region string, epoch int, r2_train double, r2_test double, mse_train double, mse_test double")


RANDOM_FORMULAS, MIN_DEPTH, MAX_DEPTH = 50, 2, 4
_LEAVES = [c for c in REGION_COLS if c != "l_tax"]


def _eight_digits(v):
    """Errors span many magnitudes: compare nine significant digits."""
    return None if v is None or not np.isfinite(v) else float(f"{v:.8e}")


def _random_formula_sql():
    parts = []
    for i in range(RANDOM_FORMULAS):
        _, t = formula.seeded_tree(i, MIN_DEPTH, MAX_DEPTH, 0, _LEAVES)
        e = f"({formula.render(t, 'duckdb')} - l_tax)"
        parts.append(f"SELECT CAST({i} AS BIGINT) AS formula_id, '{formula.render(t)}' AS expr, "
                     f"CAST({formula.length(t)} AS INTEGER) AS length, CAST(printf('%.8e', avg({e} * {e})) AS DOUBLE) AS mse FROM lineitem")
    return " UNION ALL ".join(parts)


@query("random_formula_fitness", _random_formula_sql())
def random_formula_fitness(spark, sf_dir):
    """Random complete trees (constants in [-2, 2], 2 decimals, and region
    columns as leaves) scored against l_tax over the whole table."""
    fs = formula.random_formulas(spark, RANDOM_FORMULAS, MIN_DEPTH, MAX_DEPTH, seed=0, leaves=_LEAVES).collect()
    li = table(spark, sf_dir, "lineitem")
    from voxelframe.functions.numeric import register_sql_functions
    register_sql_functions(spark)
    row = li.agg(*[F.avg((F.expr(r["expr"]) - F.col("l_tax")) ** 2).alias(f"m{r['formula_id']}") for r in fs]).first()
    # a formula whose every row divides by zero has no error value (null)
    rows = [(r["formula_id"], r["expr"], r["length"], _eight_digits(row[f"m{r['formula_id']}"])) for r in fs]
    return small_table(spark, rows, "formula_id long, expr string, length int, mse double")


def _det3_sql(m):
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"(({a})*(({e})*({i})-({f})*({h})) - ({b})*(({d})*({i})-({f})*({g})) + ({c})*(({d})*({h})-({e})*({g})))"


def _ols3_sql(cols, k, v):
    """Least-squares weights of target k from the three other columns, by
    Cramer's rule on the covariance names ``v(a, b)``; returns the
    prediction expression sum_j w_j * col_j."""
    o = [c for c in cols if c != k]
    a = [[v(r, c) for c in o] for r in o]
    rhs = [v(r, k) for r in o]
    den = _det3_sql(a)
    terms = []
    for i in range(3):
        m = [row[:] for row in a]
        for r in range(3):
            m[r][i] = rhs[r]
        terms.append(f"(({_det3_sql(m)}) / ({den})) * {o[i]}")
    return " + ".join(terms)


def _cohort_scores_sql():
    cols = REGION_COLS
    w = "(PARTITION BY l_suppkey ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
    roll = ", ".join([f"avg({c}) OVER {w} AS {c}" for c in cols] + [f"count({c}) OVER {w} AS n_{c}" for c in cols])
    full = " AND ".join(f"n_{c} = 10" for c in cols)
    stats = ", ".join([f"avg({c}) AS m_{c}" for c in cols] +
                      [f"CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
                       for c in cols])
    z = ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in cols)
    g = ", ".join(f"sum({a} * {b}) / count(*) AS v_{a}__{b}" for a in cols for b in cols)
    parts = []
    for k in cols:
        pred = _ols3_sql(cols, k, lambda a, b: f"v_{a}__{b}")
        e = f"({k} - ({pred}))"
        sse, sst = f"sum({e} * {e})", f"(var_pop({k}) * count({k}))"
        r2 = f"(CASE WHEN {sst} > 0 THEN 1 - {sse} / {sst} WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END)"
        parts.append(f"SELECT cohort, '{k}' AS region, split, count(*) AS n, round_even({r2}, 4) AS r2, "
                     f"round_even(avg({e} * {e}), 4) AS mse, round_even(avg(abs({e})), 4) AS mae "
                     f"FROM z JOIN g USING (cohort) GROUP BY cohort, split")
    return f"""WITH o AS (SELECT l_suppkey, {', '.join(cols)},
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS t FROM lineitem),
r AS (SELECT l_suppkey, t, {roll} FROM o),
f AS (SELECT l_suppkey, t, {', '.join(cols)} FROM r WHERE {full}),
j AS (SELECT f.*, CASE WHEN s_nationkey < 12 THEN 'men' ELSE 'women' END AS cohort
      FROM f JOIN supplier ON s_suppkey = f.l_suppkey),
sp AS (SELECT j.*, CASE WHEN t - min(t) OVER (PARTITION BY l_suppkey)
          < floor(CAST(0.7 AS DOUBLE) * count(*) OVER (PARTITION BY l_suppkey)) THEN 'train' ELSE 'test' END AS split FROM j),
st AS (SELECT cohort, {stats} FROM sp WHERE split = 'train' GROUP BY cohort),
z AS (SELECT sp.cohort, sp.split, {z} FROM sp JOIN st USING (cohort)),
g AS (SELECT cohort, {g} FROM z WHERE split = 'train' GROUP BY cohort)
""" + " UNION ALL ".join(parts)


@query("cohort_region_scores", _cohort_scores_sql())
def cohort_region_scores(spark, sf_dir):
    """The modelling job on a region table: scan = supplier, time = ship
    order, regions = the four numeric columns, person label = the
    supplier's nation (nations 0-11 -> men), linear models for every region
    per cohort, scores rounded half even to 4 digits."""
    from voxelframe.operators.ordinal import add_time_ordinal
    from voxelframe.plans.modelling import cohort_scores, prepare
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber",
                                                 *REGION_COLS)
    reg = add_time_ordinal(li, ["l_suppkey"], "l_shipdate", ["l_orderkey", "l_linenumber"], "t")
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_nationkey") < 12, "M").otherwise("F").alias("gender"))
    d = prepare(reg, sup, "l_suppkey", "t", REGION_COLS, "l_suppkey", "gender", "M")
    return cohort_scores(d, REGION_COLS, method="ols", digits=4)


@query("exact_split", f"""SELECT l_orderkey, l_linenumber, CASE WHEN r <= ceil(0.3 * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {sql_draw(0, 'l_orderkey', 'l_linenumber')}, {sql_draw(1, 'l_orderkey', 'l_linenumber')}) AS r,
  count(*) OVER () AS n FROM lineitem)""")
def exact_split(spark, sf_dir):
    """Seeded split with exactly ceil(0.3 n) test rows (hash-ranked)."""
    from voxelframe.operators.split import exact_size_split
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return exact_size_split(li, ["l_orderkey", "l_linenumber"], 0.3, seed=0)


@query("gbt_score_matrix")
def gbt_score_matrix(spark, sf_dir):
    """Boosted trees for every region from the others (cached input, as many
    trees as lower the error on held-out rows), scored per split: [r2_train, r2_test, mae_train, mae_test]
    rounded half even to 2 digits."""
    d = region_matrix(spark, sf_dir)
    _, sc = trees.fit_all_regions(d, REGION_COLS, split_col="split", id_cols=ROW)
    wide = sc.groupBy("region").pivot("split", ["train", "test"]).agg(F.first("r2").alias("r2"),
                                                                       F.first("mae").alias("mae"))
    return wide.select("region", *[F.bround(F.col(f"{s}_{m}"), 2).alias(f"{m}_{s}")
                                   for m in ("r2", "mae") for s in ("train", "test")])


FLAG_R2 = 0.0


@query("cross_cohort_nets")
def cross_cohort_nets(spark, sf_dir):
    """Nets trained on one cohort, saved to the weights table,
    loaded back by (cohort, region), scored on the other cohort; R² with
    swapped arguments to 4 digits and the regions flagged below 0."""
    d = region_matrix(spark, sf_dir, with_cohort=True).select(*REGION_COLS, *ROW, "split", "cohort")
    men = d.filter(F.col("cohort") == "men")
    nets, _ = net.train_synchronous(men, REGION_COLS, _init_nets(0), ROW, **NET_RULE)
    path = table_path(spark, f"net_weights_{uuid.uuid4().hex}")
    net.weights_table(spark, nets, "men").write.mode("overwrite").parquet(path)
    loaded = net.nets_from_table(spark.read.parquet(path), "men")
    m = net.score(d.filter(F.col("cohort") == "women"), REGION_COLS, loaded)
    return m.select("region", "n", F.bround(F.col("r2_swapped"), 4).alias("r2"),
                    (F.col("r2_swapped") < F.lit(FLAG_R2)).alias("flagged"))

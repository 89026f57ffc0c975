"""Gram/linear fits, confound regression, nets, formulas, trees,
extraction and the incremental stream -- checked against NumPy."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import formula, linear, metrics, net, smooth, trees
from voxelframe.plans.extract import extract_regions


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(5)
    n, d = 4000, 5
    latent = rng.normal(size=n)
    x = np.stack([latent * (i + 1) * 0.3 + rng.normal(size=n) for i in range(d)], axis=1)
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(d)])
    pdf["rid"] = np.arange(n)
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_gram_and_cov(spark, wide):
    pdf, df = wide
    cols = [f"x{i}" for i in range(5)]
    v = df.select(F.array(*cols).alias("v"))
    mu = linear.centred_gram(v, "v", 5, np.zeros(5))[1]
    n, g = linear.gram(v, "v", 5, center=mu)
    cov, corr = linear.covariance_from_gram(n, g)
    x = pdf[cols].to_numpy()
    np.testing.assert_allclose(cov, np.cov(x, rowvar=False, ddof=0), atol=1e-10)
    np.testing.assert_allclose(corr, np.corrcoef(x, rowvar=False), atol=1e-10)
    pairs = linear.covariance_pairs(df, cols).toPandas()
    r = pairs[(pairs.ci == "x0") & (pairs.cj == "x3")].iloc[0]
    assert r["corr"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 3])[0, 1])


def _lasso_cd(x, y, alpha, iters=5000):
    """Plain coordinate descent on centred raw data (the sklearn objective)."""
    x = x - x.mean(0)
    y = y - y.mean()
    n, p = x.shape
    b = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = y - x @ b + x[:, j] * b[j]
            rho = x[:, j] @ r / n
            b[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (x[:, j] @ x[:, j] / n)
    return b


def test_lasso_and_ols_all_targets(spark, wide):
    pdf, df = wide
    cols = [f"x{i}" for i in range(5)]
    x = pdf[cols].to_numpy()
    cov = np.cov(x, rowvar=False, ddof=0)
    w = linear.lasso_all_targets(cov, 0.05)
    for k in range(5):
        others = [j for j in range(5) if j != k]
        np.testing.assert_allclose(w[k, others], _lasso_cd(x[:, others], x[:, k], 0.05), atol=1e-6)
    wo = linear.ols_all_targets(cov)
    xc = x - x.mean(0)
    for k in range(5):
        others = [j for j in range(5) if j != k]
        np.testing.assert_allclose(wo[k, others], np.linalg.lstsq(xc[:, others], xc[:, k], rcond=None)[0],
                                   atol=1e-8)
    p = linear.predict_all_targets(df, cols, x.mean(0), wo).toPandas().sort_values("rid")
    np.testing.assert_allclose(p["p_x0"], x.mean(0)[0] + xc[:, 1:] @ wo[0, 1:], atol=1e-9)


def test_confound_residuals(spark):
    rng = np.random.default_rng(6)
    rows = []
    for s in range(4):
        n = 40 + 10 * s
        c = rng.normal(size=(n, 3))
        y = c @ rng.normal(size=3) + 0.1 * rng.normal(size=n) + s
        for t in range(n):
            rows.append((s, t, float(y[t]), *map(float, c[t])))
    # a scan where the region equals 2 * c0: residual 0
    for t in range(30):
        c0 = float(rng.normal())
        rows.append((9, t, 2 * c0, c0, float(rng.normal()), float(rng.normal())))
    pdf = pd.DataFrame(rows, columns=["scan", "t", "x0", "c0", "c1", "c2"])
    got = linear.confound_residuals(spark.createDataFrame(pdf), ["scan"], ["x0"], ["c0", "c1", "c2"]) \
        .toPandas().sort_values(["scan", "t"])
    for s, g in pdf.groupby("scan"):
        z = np.column_stack([np.ones(len(g)), g[["c0", "c1", "c2"]].to_numpy()])
        b = np.linalg.lstsq(z, g["x0"].to_numpy(), rcond=None)[0]
        np.testing.assert_allclose(got[got.scan == s]["x0"], g["x0"] - z @ b, atol=1e-8)
    one = linear.single_confound_residual(spark.createDataFrame(pdf[pdf.scan == 9]), ["scan"], "x0", "c0")
    assert np.abs(one.toPandas()["x0"]).max() < 1e-9


def test_net_gradients_and_training(spark, wide):
    rng = np.random.default_rng(7)
    layers = net.init_net(rng, 4)
    x = rng.normal(size=(30, 4))
    y = rng.normal(size=30)
    hs, zs = net.forward(layers, x)
    g = net.flatten(net.backward(layers, hs, zs, y))
    vec = net.flatten(layers)

    def loss(v):
        p = net.forward(net.unflatten(v, 4), x)[0][-1][:, 0]
        return ((p - y) ** 2).sum()

    for i in rng.choice(len(vec), 25, replace=False):
        e = np.zeros_like(vec)
        e[i] = 1e-6
        num = (loss(vec + e) - loss(vec - e)) / 2e-6
        assert g[i] == pytest.approx(num, rel=1e-4, abs=1e-6)

    pdf, df = wide
    cols = [f"x{i}" for i in range(5)]
    d = df.withColumn("split", F.when(F.col("rid") % 4 == 0, "test").otherwise("train")).persist()
    nets = {c: net.init_net(np.random.default_rng(i), 4) for i, c in enumerate(cols)}
    # scoring equals NumPy
    m = {(r["region"], r["split"]): r for r in net.score(d, cols, nets, "split").collect()}
    xa = pdf[cols].to_numpy()
    te = (pdf["rid"] % 4 == 0).to_numpy()
    p = net.forward(nets["x2"], np.delete(xa, 2, axis=1)[te])[0][-1][:, 0]
    assert m[("x2", "test")]["mse"] == pytest.approx(np.mean((xa[te, 2] - p) ** 2))
    # training lowers the error of every net
    _, hist = net.train(d, cols, nets, max_epochs=6)
    d.unpersist()
    h = pd.DataFrame(hist, columns=["region", "epoch", "r2_train", "r2_test", "mse_train", "mse_test"])
    for c in cols:
        g = h[h.region == c].sort_values("epoch")
        assert g["mse_train"].iloc[-1] < g["mse_train"].iloc[0]
    # weights table round trip
    wt = net.weights_table(spark, nets, "men")
    back = net.nets_from_table(wt, "men")
    np.testing.assert_allclose(back["x1"][2][0], nets["x1"][2][0])


def test_formulas(spark, wide):
    pdf, df = wide
    trees_ = {
        1: ("add", ("mul", "x0", 0.5), ("div", "x1", "x2")),
        2: ("sub", ("cos", "x3"), ("sin", ("mul", "x4", 2.0))),
        3: ("div", "x0", ("sub", "x1", "x1")),          # protected: denominator 0 -> 1
    }
    ev = formula.evaluate(df, trees_, ["rid"]).toPandas().sort_values("rid")
    cols = {c: pdf[c].to_numpy() for c in pdf.columns}
    for fid, t in trees_.items():
        np.testing.assert_allclose(ev[f"f{fid}"], formula.eval_numpy(t, cols), rtol=1e-12, atol=1e-12)
    assert (ev["f3"] == 1.0).all()
    targets = {1: "x3", 2: "x3", 3: "x4"}
    fe = {r["formula_id"]: r for r in formula.fitness(df, trees_, targets, parsimony=0.01).collect()}
    for fid, t in trees_.items():
        num = formula.fitness_numpy(df, {fid: t}, targets[fid], [f"x{i}" for i in range(5)], 0.01)
        assert fe[fid]["mse"] == pytest.approx(num[fid][0], rel=1e-12)
        assert fe[fid]["fitness"] == pytest.approx(num[fid][1], rel=1e-12)
        assert fe[fid]["length"] == formula.length(t)
    best = {r["region"]: r["formula_id"] for r in formula.best_per_region(
        formula.fitness(df, trees_, targets, parsimony=0.01)).collect()}
    assert set(best) == {"x3", "x4"}


def test_random_formulas_and_search(spark, wide):
    a = formula.random_formulas(spark, 40, 1, 3, seed=3).toPandas().sort_values("formula_id")
    b = formula.random_formulas(spark, 40, 1, 3, seed=3).repartition(5).toPandas().sort_values("formula_id")
    assert list(a["expr"]) == list(b["expr"])
    assert a["depth"].between(1, 3).all()
    # complete trees: 2^(depth+1) - 1 nodes
    assert (a["length"] == 2 ** (a["depth"] + 1) - 1).all()
    pdf, df = wide
    best, mse, hist = formula.symbolic_search(df, "x4", ["x0", "x1", "x2", "x3"], population=30,
                                              generations=4, tournament=4, init_depth=(1, 3),
                                              id_cols=["rid"], seed=1)
    assert len(hist) >= 1 and mse <= np.var(pdf["x4"]) * 1.5
    assert hist[-1][1] <= hist[0][1] + 1e-12 or min(h[1] for h in hist) <= hist[0][1]


def test_net_training_stops_by_its_rule(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 3))
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["d"] = 0.8 * pdf.a - 0.5 * pdf.b + 0.1 * rng.normal(size=3000)
    pdf["split"] = np.where(np.arange(3000) % 4 == 0, "test", "train")
    d = spark.createDataFrame(pdf).repartition(2).persist()
    nets = {"d": net.init_net(rng, 3, (8, 6, 4))}
    found, hist = net.train(d, ["a", "b", "c", "d"], nets, max_epochs=200, batch_rows=128, tol=0.02)
    assert 3 < len(hist) < 200
    scores = {r["split"]: r["r2"] for r in net.score(d, ["a", "b", "c", "d"], found, "split").collect()}
    assert scores["train"] > 0.9 and scores["test"] > 0.9
    far = d.withColumns({c: F.col(c) + 1e7 for c in "abcd"})           # unscaled regions keep their R²
    shifted = net.score(far, ["a", "b", "c", "d"], {"d": [(np.zeros((1, 3)), np.array([1e7]))]})
    assert shifted.first()["r2"] == pytest.approx(1 - np.mean(pdf["d"] ** 2) / np.var(pdf["d"]), abs=1e-6)
    d.unpersist()


def test_synchronous_training_is_one_sequence_of_updates(spark):
    """Every number of tasks gives what a NumPy run over the same slices gives."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(1000, 3)), columns=["a", "b", "c"])
    pdf["c"] += 0.7 * pdf.a
    pdf["rid"] = rng.permutation(1000)
    pdf["split"] = np.where(np.arange(1000) % 5 == 0, "test", "train")
    cols, epochs, size = ["a", "b", "c"], 4, 150
    nets = {c: net.init_net(np.random.default_rng(i), 2, (6, 5, 4)) for i, c in enumerate(cols)}
    rows = pdf[pdf.split == "train"].sort_values("rid")[cols].to_numpy()
    want = {}
    for k, c in enumerate(cols):
        p, m, v, step = net.flatten(nets[c]), 0.0, 0.0, 0
        want[c] = []
        for _ in range(epochs):                 # epoch e is measured before its updates
            want[c].append(p)
            for at in range(0, len(rows), size):
                x, y = np.delete(rows[at:at + size], k, axis=1), rows[at:at + size, k]
                layers = net.unflatten(p, 2, (6, 5, 4))
                g = net.flatten(net.backward(layers, *net.forward(layers, x), y)) / len(y)
                step += 1
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                p = p - 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    for parts, tasks in ((1, 1), (8, 4), (3, 3)):
        d = spark.createDataFrame(pdf).repartition(parts)
        found, hist = net.train_synchronous(d, cols, nets, ["rid"], epochs, batch_rows=size, tasks=tasks)
        assert [h[1] for h in hist if h[0] == "a"] == [0, 1, 2, 3]
        for k, c in enumerate(cols):
            x, y = np.delete(rows, k, axis=1), rows[:, k]
            mse = [np.mean((y - net.forward(net.unflatten(p, 2, (6, 5, 4)), x)[0][-1][:, 0]) ** 2) for p in want[c]]
            assert [x[4] for x in hist if x[0] == c] == pytest.approx(mse, rel=1e-9)
            np.testing.assert_allclose(net.flatten(found[c]), want[c][int(np.argmin(mse))], rtol=1e-7, atol=1e-10)


def test_synchronous_training_odd_tables(spark):
    nets = {"a": net.init_net(np.random.default_rng(0), 1, (2, 2))}
    few = spark.createDataFrame([(1.0, 2.0, 1, "train"), (2.0, 1.0, 2, None)], "a double, b double, rid int, split string")
    found, hist = net.train_synchronous(few, ["a", "b"], nets, ["rid"], 2, tasks=4)
    assert len(hist) == 2 and hist[1][4] < hist[0][4] and hist[0][5] is not None
    _, hist = net.train_synchronous(few.limit(0), ["a", "b"], nets, ["rid"], 2, tasks=4)
    assert hist[0][2:] == (None, None, None, None)


def test_training_memory_does_not_grow_with_the_rows(monkeypatch):
    import tracemalloc

    from pyspark import BarrierTaskContext

    class Alone:
        def allGather(self, told):
            return [told]

        def partitionId(self):
            return 0
    monkeypatch.setattr(BarrierTaskContext, "get", classmethod(lambda cls: Alone()))
    rng, cols = np.random.default_rng(6), ["a", "b", "c"]
    rows = rng.normal(size=(31 * 8096, 3))
    nets = {"c": net.init_net(rng, 2)}

    def batches():
        for i in range(31):                       # thirty of test rows, then four slices in one
            pdf = pd.DataFrame(rows[i * 8096:(i + 1) * 8096], columns=cols)
            yield pdf.assign(_slice=-1 if i < 30 else np.arange(8096) // 2024)
    tracemalloc.start()
    found = pd.concat(net._sync_epoch(batches(), nets, {}, cols, np.zeros(3), 0.01, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20                        # 676 MiB before, about 3 KB a test row
    p, y = net.forward(nets["c"], rows[:30 * 8096, :2])[0][-1][:, 0], rows[:30 * 8096, 2]
    test = found[found.split == "test"].iloc[0]
    assert (test.n, test.see, test.spp) == pytest.approx((len(y), np.sum((y - p) ** 2), np.sum(p ** 2)), rel=1e-9)
    assert found[found.split == "train"].n.sum() == 8096 and found[found.split == "state"].k.iloc[0] == 4


def test_every_training_task_holds_one_share(spark, monkeypatch):
    d = spark.range(24000).selectExpr("id", "rand(1) as a", "rand(2) as b", "'train' as split")
    plain, held = type(d).persist, []

    def seen(self, *args):
        held.append(sorted(r["count"] for r in self.groupBy(F.spark_partition_id()).count().collect()))
        return plain(self, *args)
    monkeypatch.setattr(type(d), "persist", seen)
    nets = {"a": net.init_net(np.random.default_rng(0), 1, (2, 2))}
    for tasks in (2, 3, 4):                       # a task with two shares before
        net.train_synchronous(d, ["a", "b"], nets, ["id"], 1, tasks=tasks)
    assert held == [[24000 // n] * n for n in (2, 3, 4)]


def test_cohort_nets_train_on_even_shares(spark, tmp_path, monkeypatch):
    from voxelframe.plans import q_models
    rng, n = np.random.default_rng(9), 4000
    lines = pd.DataFrame({"l_orderkey": np.arange(n) // 4, "l_linenumber": np.arange(n) % 4, "l_quantity": rng.normal(size=n),
                          "l_extendedprice": rng.normal(size=n), "l_discount": rng.normal(size=n), "l_tax": rng.normal(size=n),
                          "l_shipdate": pd.Timestamp("1998-01-01")})
    orders = pd.DataFrame({"o_orderkey": np.arange(1000), "o_custkey": np.arange(1000) % 2})
    people = pd.DataFrame({"c_custkey": [0, 1], "c_mktsegment": ["BUILDING", "MACHINERY"]})
    lines["l_shipdate"] = lines["l_shipdate"].astype("datetime64[us]")
    for name, rows in (("lineitem", lines), ("orders", orders), ("customer", people)):
        rows.to_parquet(tmp_path / f"{name}.parquet")
    monkeypatch.setattr(q_models, "NET_RULE", {"max_epochs": 1})
    plain, held = type(spark.range(1)).persist, []

    def seen(self, *args):
        if "_slice" in self.columns:
            held.append(sorted(r["count"] for r in self.groupBy(F.spark_partition_id()).count().collect()))
        return plain(self, *args)
    monkeypatch.setattr(type(spark.range(1)), "persist", seen)
    found = q_models.cross_cohort_nets(spark, str(tmp_path)).collect()
    assert held == [[500] * 4]                    # two thousand men's rows; a task with two shares before
    assert {(r["region"], r["n"]) for r in found} == {(c, 2000) for c in q_models.REGION_COLS}


def test_net_goes_on_while_small_falls_add_up(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(1200, 2)), columns=["a", "b"])
    pdf["y"] = pdf.a + 0.5 * pdf.b
    pdf["split"] = "train"
    d = spark.createDataFrame(pdf).repartition(1).persist()
    _, hist = net.train(d, ["a", "b", "y"], {"y": net.init_net(rng, 2, (8, 6, 4))}, max_epochs=12, lr=0.0008,
                        batch_rows=400, tol=0.02)
    mse = [h[4] for h in hist]
    print(mse)
    assert len(mse) == 12 and all(0.98 < b / a < 1 for a, b in zip(mse, mse[1:]))
    d.unpersist()


def test_gbt_stops_by_its_rule(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(1500, 3)), columns=["a", "b", "c"])
    pdf["y"] = np.sign(pdf.a) + 0.1 * rng.normal(size=1500)
    pdf["id"] = np.arange(1500)
    df = spark.createDataFrame(pdf).persist()
    model, feats, va = trees.fit_region(df, ["a", "b", "c", "y"], "y", id_cols=["id"], min_gain=0.05, stepSize=0.5)
    assert 1 <= model.getNumTrees < 30
    err = trees.predict(model, va, df).agg(F.avg((F.col("_pred") - F.col("y")) ** 2)).first()[0]
    assert err < 0.1
    df.unpersist()


def test_gbt_goes_on_while_held_out_rows_gain(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(4000, 3)), columns=["a", "b", "c"])
    pdf["y"] = pdf.a * pdf.b + np.sin(2 * pdf.c) + 0.3 * rng.normal(size=4000)     # gains of under 1 % a tree
    pdf["noise"] = rng.normal(size=4000)
    pdf["id"] = np.arange(4000)
    df = spark.createDataFrame(pdf).repartition(2).persist()
    train, test = df.filter("id < 3000"), df.filter("id >= 3000")
    model, feats, va = trees.fit_region(train, ["a", "b", "c", "y"], "y", max_iter=90, id_cols=["id"])
    assert model.getNumTrees > 60
    got = trees.predict(model, va, test).select("y", "_pred").toPandas()
    assert 1 - np.mean((got.y - got._pred) ** 2) / np.var(got.y) > 0.8
    # nothing to learn: ended and cut back to the best count
    model, feats, va = trees.fit_region(train, ["a", "b", "c", "noise"], "noise", max_iter=90, id_cols=["id"])
    assert model.getNumTrees <= 10
    df.unpersist()


def test_gbt_is_fitted_on_cells_of_bins_as_on_rows(spark, tmp_path, monkeypatch):
    from pyspark.ml import Estimator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rng.integers(0, 8, 30000), "b": rng.integers(-3, 4, 30000) / 2, "c": rng.normal(size=30000)})
    pdf["y"] = pdf.a * pdf.b + np.sin(2 * pdf.c) + 0.3 * rng.normal(size=30000)
    df = spark.createDataFrame(pdf).repartition(3).persist()
    df.count()
    feats = ["a", "b", "c"]
    rows = VectorAssembler(inputCols=feats, outputCol="_features").transform(df)
    want = GBTRegressor(featuresCol="_features", labelCol="y", predictionCol="_pred", maxIter=12, **trees.GBT_DEFAULTS).fit(rows)
    plain, sizes = Estimator.fit, []

    def counted(self, dataset, params=None):
        sizes.append(dataset.count())
        return plain(self, dataset, params)
    monkeypatch.setattr(Estimator, "fit", counted)
    monkeypatch.setattr(trees, "CELLS_FROM", 0, raising=False)
    got, _, va = trees.fit_region(df, [*feats, "y"], "y", max_iter=12)
    monkeypatch.setattr(Estimator, "fit", plain)
    assert max(sizes) <= 8 * 7 * 32                 # 30,000 before
    nodes = []
    for name, model in (("got", got), ("want", want)):
        trees.save_model(model, str(tmp_path / name))
        nodes.append(trees.node_table(spark, str(tmp_path / name)).toPandas().sort_values(["tree", "node"]).reset_index(drop=True))
    assert len(nodes[0]) > 200
    same = ["tree", "node", "feature", "threshold", "rows"]
    pd.testing.assert_frame_equal(nodes[0][same], nodes[1][same], check_exact=True)
    np.testing.assert_allclose(nodes[0].gain.dropna(), nodes[1].gain.dropna(), rtol=1e-6)
    np.testing.assert_allclose(trees.predict(got, va, df).toPandas()._pred, trees.predict(want, va, df).toPandas()._pred, rtol=1e-9, atol=1e-9)
    # errors on other rows: those of the rows less the scatter inside cells
    train, held = df.filter("c < 1"), df.filter("c >= 1")
    boosting = trees.CellBoosting(train, feats, "y", **trees.GBT_DEFAULTS)
    boosting.grow(3)                                # goes on from there
    errors = boosting.errors(boosting.held_cells(held), 12)
    whole = GBTRegressor(featuresCol="_features", labelCol="y", maxIter=12, **trees.GBT_DEFAULTS).fit(
        rows.filter("c < 1")).evaluateEachIteration(rows.filter("c >= 1"), "squared")
    np.testing.assert_allclose(np.diff(errors), np.diff(whole), rtol=1e-6, atol=1e-9)
    for bad in (None, float("nan")):
        for c in ("a", "y"):
            with pytest.raises(Exception, match="null"):
                trees.fit_region(df.withColumn(c, F.when(F.col("c") < 2, F.col(c).cast("double")).otherwise(F.lit(bad))), [*feats, "y"], "y", max_iter=1)
    df.unpersist()


def test_gram_by_rules(spark):
    rng = np.random.default_rng(11)
    for dim in (4, 17):
        x = rng.normal(size=(400, dim))
        cols = [f"x{i}" for i in range(dim)]
        pdf = pd.DataFrame(x, columns=cols)
        pdf["k"] = np.arange(400) % 50
        rows = [tuple(None if (i == 3 and j == 0) else v for j, v in enumerate(r)) for i, r in enumerate(pdf.itertuples(index=False))]
        df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", k long").repartition(5)
        with pytest.raises(ValueError):
            linear.gram_by(df, "k", cols, max_groups=10)
        got = linear.gram_by(df, "k", cols, max_groups=50)
        assert len(got) == 50
        for k, (n, g) in got.items():
            want = x[[i for i in range(400) if i % 50 == k and i != 3]]     # the row with a null is left out
            assert n == len(want)
            np.testing.assert_allclose(g, want.T @ want, atol=1e-9)


def test_confound_residuals_with_nulls(spark):
    rng = np.random.default_rng(12)
    z = rng.normal(size=(240, 5)) * [1, 100, 1e-3, 1, 5] + [0, 1000, 0, 7, 0]
    y = rng.normal(size=(240, 3)) + z[:, [0]] * 2
    hole = rng.random((240, 8)) < 0.1
    full = np.where(hole, np.nan, np.hstack([z, y]))
    full[:, 4] = 5.0                                                       # a constant confound
    rows = [(int(i % 3), i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(full)]
    cs, ys = [f"c{i}" for i in range(5)], ["x0", "x1", "x2"]
    df = spark.createDataFrame(rows, "scan int, t int, " + ", ".join(f"{c} double" for c in cs + ys)).repartition(4)
    got = linear.confound_residuals(df, ["scan"], ys, cs).toPandas().set_index("t")
    for scan in range(3):
        at = np.arange(scan, 240, 3)
        for j, c in enumerate(ys):
            sound = at[~np.isnan(full[at][:, [0, 1, 2, 3, 4, 5 + j]]).any(axis=1)]
            a = np.column_stack([np.ones(len(sound)), full[sound, :5]])
            want = full[sound, 5 + j] - a @ np.linalg.lstsq(a, full[sound, 5 + j], rcond=None)[0]
            np.testing.assert_allclose(got.loc[sound, c], want, atol=1e-8)
            assert got.loc[np.setdiff1d(at, sound), c].isna().all()


def test_cohort_scores_48_columns(spark):
    from voxelframe.plans.modelling import cohort_scores
    rng = np.random.default_rng(13)
    n, d = 1200, 48
    x = rng.normal(size=(n, 6)) @ rng.normal(size=(6, d)) + rng.normal(size=(n, d)) * 0.5 + 1000.0
    cols = [f"x{i}" for i in range(d)]
    pdf = pd.DataFrame(x, columns=cols)
    pdf["cohort"] = np.where(np.arange(n) % 3 == 0, "men", "women")
    pdf["split"] = np.where(np.arange(n) % 5 == 0, "test", "train")
    got = cohort_scores(spark.createDataFrame(pdf).repartition(4), cols).toPandas().set_index(["cohort", "split", "region"])
    for cohort in ("men", "women"):
        own = pdf[pdf.cohort == cohort]
        tr = own[own.split == "train"][cols].to_numpy()
        mean, sd = tr.mean(0), tr.std(0)
        for k in (0, 31):
            rest = np.delete(np.arange(d), k)
            w = np.linalg.lstsq(((tr - mean) / sd)[:, rest], ((tr - mean) / sd)[:, k], rcond=None)[0]
            for split in ("train", "test"):
                zs = (own[own.split == split][cols].to_numpy() - mean) / sd
                e = zs[:, k] - zs[:, rest] @ w
                r = got.loc[(cohort, split, f"x{k}")]
                assert r["n"] == len(zs)
                np.testing.assert_allclose([r["r2"], r["mse"], r["mae"]],
                                           [1 - (e @ e) / (len(e) * zs[:, k].var()), np.mean(e ** 2), np.abs(e).mean()], rtol=1e-6)


def test_volume_smoothing(spark):
    rng = np.random.default_rng(14)
    vol = rng.normal(size=(4, 3, 5))
    vol[1, 1, 1] = np.nan
    rows = [(7, a, b, c, float(vol[a, b, c])) for a in range(4) for b in range(3) for c in range(5) if not np.isnan(vol[a, b, c])]
    kernel = smooth.gaussian_kernel_3d(2.0, 1)
    got = smooth.smooth_volume(spark.createDataFrame(rows, "scan int, x int, y int, z int, v double"), ["scan"], "v", kernel, "s")
    assert got.count() == len(rows)
    for r in got.collect():
        num = den = 0.0
        for a, b, c, w in kernel:
            p = (r["x"] + a, r["y"] + b, r["z"] + c)
            if all(0 <= i < m for i, m in zip(p, vol.shape)) and not np.isnan(vol[p]):
                num, den = num + w * vol[p], den + w
        assert r["s"] == pytest.approx(num / den)


def test_volume_smoothing_axis_by_axis(spark):
    """Radius 3 with most voxels missing: neighbours reach each other over
    places that hold none; a voxel without a value takes its neighbours'."""
    rng = np.random.default_rng(15)
    vol = np.where(rng.random((6, 7, 8)) < 0.3, rng.normal(size=(6, 7, 8)), np.nan)
    empty = tuple(np.argwhere(np.isnan(vol))[3])
    rows = [(7, *map(int, p), float(vol[p])) for p in np.ndindex(vol.shape) if not np.isnan(vol[p])]
    rows += [(7, *map(int, empty), None), (8, 0, 0, 0, None), (8, 100, 0, 0, 2.5)]
    line = smooth.gaussian_kernel(2.5, 3)
    got = smooth.smooth_volume(spark.createDataFrame(rows, "scan int, x int, y int, z int, v double"), ["scan"], "v", line, "s")
    found = {tuple(r)[:4]: r["s"] for r in got.collect()}
    assert set(found) == {r[:4] for r in rows}
    assert found[(8, 0, 0, 0)] is None and found[(8, 100, 0, 0)] == pytest.approx(2.5)
    for (scan, *at), s in found.items():
        if scan == 8:
            continue
        num = den = 0.0
        for a, b, c, w in smooth.gaussian_kernel_3d(2.5, 3):
            p = (at[0] + a, at[1] + b, at[2] + c)
            if all(0 <= i < m for i, m in zip(p, vol.shape)) and not np.isnan(vol[p]):
                num, den = num + w * vol[p], den + w
        assert s == pytest.approx(num / den, rel=1e-9)


def test_metrics_with_missing_values(spark):
    rows = [(1.0, 1.5), (2.0, None), (4.0, 3.5), (None, 1.0), (9.0, 8.0), (None, None)]
    both = np.array([r for r in rows if None not in r])
    df = spark.createDataFrame(rows, "y double, p double")
    r = metrics.regression_metrics(df, [], "y", "p").first()
    sse = ((both[:, 0] - both[:, 1]) ** 2).sum()
    assert (r["n"], r["mse"]) == (3, pytest.approx(sse / 3))
    assert r["r2"] == pytest.approx(1 - sse / (both[:, 0].var() * 3))
    assert metrics.regression_metrics(df, [], "y", "p", "prediction").first()["r2"] == pytest.approx(
        1 - sse / (both[:, 1].var() * 3))
    none = metrics.regression_metrics(df.filter("p is null"), [], "y", "p").first()
    assert none["n"] == 0 and none["mse"] is None


def test_gbt_importance(spark, wide):
    pdf, df = wide
    cols = [f"x{i}" for i in range(5)]
    model, feats, va = trees.fit_region(df, cols, "x4", max_iter=3)
    imp = trees.importance_table(spark, model, feats, "x4").toPandas()
    assert set(imp["feature"]) <= set(feats) and abs(imp["importance"].sum() - 1.0) < 1e-9
    pred = trees.predict(model, va, df)
    assert "_pred" in pred.columns


def test_split_counts_equal_a_walk_over_the_trees(spark, wide, tmp_path):
    import re
    _, df = wide
    cols = [f"x{i}" for i in range(5)]
    model, feats, _ = trees.fit_region(df, cols, "x4", max_iter=8)
    trees.save_model(model, str(tmp_path / "m"))
    walked = re.findall(r"If \(feature (\d+) <= ([^)]+)\)", model.toDebugString)
    want = pd.Series([feats[int(f)] for f, _ in walked]).value_counts()
    rows = trees.split_counts(spark, str(tmp_path / "m"), feats, "x4").collect()
    assert {r["feature"]: r["splits"] for r in rows} == want.to_dict()
    assert [r["splits"] for r in rows] == sorted(want, reverse=True)
    nodes = trees.node_table(spark, str(tmp_path / "m"))
    assert sorted(nodes.filter("feature is not null").toPandas()["threshold"]) == sorted(float(t) for _, t in walked)
    assert nodes.filter("feature is null").count() == model.toDebugString.count("Predict:")
    assert nodes.filter("node = 0").agg(F.min("rows")).first()[0] > 0


def test_fits_side_by_side_give_the_same_models(spark, wide):
    _, df = wide
    cols = [f"x{i}" for i in range(5)]
    d = df.withColumn("split", F.when(F.col("rid") % 4 == 0, "test").otherwise("train"))
    runs = [[sorted(map(tuple, x.collect())) for x in trees.fit_all_regions(d, cols, max_iter=4, split_col="split", at_once=n)]
            for n in (1, 3)]
    assert runs[0] == runs[1] and len(runs[0][1]) == 10
    # work inherits the caller's properties, keeps its order, and its first error comes through
    sc = spark.sparkContext
    sc.setLocalProperty("whose", "caller")

    def work(i):
        if i == 7:
            raise KeyError(i)
        return i, sc.getLocalProperty("whose"), sc.getLocalProperty("spark.scheduler.pool")
    assert trees.side_by_side(spark, work, range(6), 3) == [(i, "caller", f"side_{i % 3}") for i in range(6)]
    assert sc.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(KeyError):
        trees.side_by_side(spark, work, [1, 7, 2], 2)
    sc.setLocalProperty("whose", None)


def test_smoothing_forms_agree(spark):
    rng = np.random.default_rng(8)
    vecs = rng.normal(size=(20, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, emb array<double>")
    k = smooth.gaussian_kernel(2.0, 2)
    a = smooth.smooth_array(df, "emb", k, "s").select("vec_id", F.posexplode("s").alias("pos", "s")).toPandas()
    long = df.select("vec_id", F.posexplode("emb").alias("pos", "v"))
    b = smooth.smooth_long(long, ["vec_id"], "pos", "v", k, "s").toPandas()
    m = a.merge(b, on=["vec_id", "pos"])
    assert len(m) == 240
    np.testing.assert_allclose(m["s_x"], m["s_y"], atol=1e-12)
    w = np.array([wt for _, wt in k])
    x = vecs[3]
    want = [sum(w[o + 2] * x[i + o] for o in range(-2, 3) if 0 <= i + o < 12) /
            sum(w[o + 2] for o in range(-2, 3) if 0 <= i + o < 12) for i in range(12)]
    np.testing.assert_allclose(a[a.vec_id == 3].sort_values("pos")["s"], want, atol=1e-12)


def _voxels(spark, scans=("s0", "s1", "s2")):
    rng = np.random.default_rng(9)
    rows = []
    for s in scans:
        for v in range(60):
            for t in range(40):
                rows.append((s, v, t, float(rng.normal() + (v % 6) * 0.1 * t)))
    return spark.createDataFrame(rows, "scan_id string, voxel_id bigint, t int, value double")


def test_extract_regions(spark):
    vox = _voxels(spark)
    labels_pdf = pd.DataFrame({"voxel_id": range(60), "label": [0 if v < 5 else (1 if v == 5 else 2 + v % 4)
                                                                 for v in range(60)]})
    atlas = spark.createDataFrame(labels_pdf)
    out = extract_regions(vox, atlas, [1, 2, 3, 4, 5], standardize=True).toPandas()
    vp = vox.toPandas().merge(labels_pdf, on="voxel_id")
    vp = vp[vp.label != 0]
    means = vp.groupby(["scan_id", "t", "label"])["value"].mean().unstack()
    for s in ("s0", "s2"):
        m = means.loc[s].sort_index()
        z = (m - m.mean()) / m.std(ddof=0)
        g = out[out.scan_id == s].sort_values("t")
        np.testing.assert_allclose(g[["x0", "x1", "x2", "x3", "x4"]].to_numpy(), z.to_numpy(), atol=1e-9)


def test_incremental_stream(spark, tmp_path):
    from voxelframe.streaming.incremental import start_incremental_extract
    src = tmp_path / "vox"
    out = str(tmp_path / "regions")
    atlas = spark.createDataFrame([(v, 1 + v % 3) for v in range(60)], "voxel_id bigint, label int")
    vox = _voxels(spark, ("a", "b", "c"))
    for s in ("a", "b"):
        vox.filter(F.col("scan_id") == s).coalesce(1).write.parquet(str(src / f"scan={s}"))
    name = f"t{os.getpid()}_{abs(hash(str(tmp_path)))}"
    q = start_incremental_extract(spark, str(src / "*"), atlas, [1, 2, 3], out, name=name)
    q.awaitTermination(120)
    assert sorted(r[0] for r in spark.read.parquet(out).select("scan_id").distinct().collect()) == ["a", "b"]
    vox.filter(F.col("scan_id") == "c").coalesce(1).write.parquet(str(src / "scan=c"))
    q = start_incremental_extract(spark, str(src / "*"), atlas, [1, 2, 3], out, name=name)
    q.awaitTermination(120)
    res = spark.read.parquet(out)
    assert sorted(r[0] for r in res.select("scan_id").distinct().collect()) == ["a", "b", "c"]
    assert res.count() == 3 * 40


def test_regression_metrics_semantics(spark):
    from voxelframe.operators import metrics as M
    rng = np.random.default_rng(23)
    y = rng.normal(size=200)
    p = y + rng.normal(scale=0.3, size=200)
    rows = [("noisy", float(a), float(b)) for a, b in zip(y, p)]
    rows += [("exact", float(a), float(a)) for a in y[:20]]
    rows += [("const_exact", 2.0, 2.0)] * 5 + [("const_miss", 2.0, 2.5)] * 5
    df = spark.createDataFrame(rows, "g string, y double, p double")
    got = {r["g"]: r for r in M.regression_metrics(df, ["g"], "y", "p").collect()}
    sw = {r["g"]: r for r in M.regression_metrics(df, ["g"], "y", "p", denominator="prediction").collect()}

    def r2(a, b):
        sse, sst = ((a - b) ** 2).sum(), ((a - a.mean()) ** 2).sum()
        return 1 - sse / sst if sst > 0 else (1.0 if sse == 0 else 0.0)

    assert got["noisy"]["r2"] == pytest.approx(r2(y, p))
    assert sw["noisy"]["r2"] == pytest.approx(r2(p, y))          # arguments swapped
    assert got["noisy"]["mse"] == pytest.approx(np.mean((y - p) ** 2))
    assert got["noisy"]["mae"] == pytest.approx(np.mean(np.abs(y - p)))
    assert got["exact"]["r2"] == 1.0
    assert got["const_exact"]["r2"] == 1.0 and got["const_miss"]["r2"] == 0.0
    sm = M.score_matrix(df.filter(F.col("g") == "noisy").withColumn(
        "split", F.when(F.rand(1) < 0.3, "test").otherwise("train")), ["g"], "split", "y", "p").first()
    assert set(sm.asDict()) == {"g", "r2_train", "r2_test", "mae_train", "mae_test"}
    assert sm["r2_train"] == round(sm["r2_train"], 2)


def test_stream_scan_split_over_batches(spark, tmp_path):
    from voxelframe.streaming.incremental import start_incremental_extract
    src = tmp_path / "vox"
    out = str(tmp_path / "regions")
    atlas = spark.createDataFrame([(v, 1 + v % 3) for v in range(60)], "voxel_id bigint, label int")
    vox = _voxels(spark, ("a", "b"))
    # scan a arrives in two halves (by time), in two different runs
    vox.filter((F.col("scan_id") == "a") & (F.col("t") < 20)).coalesce(1).write.parquet(str(src / "a1"))
    vox.filter(F.col("scan_id") == "b").coalesce(1).write.parquet(str(src / "b1"))
    name = f"split{os.getpid()}_{abs(hash(str(tmp_path)))}"
    start_incremental_extract(spark, str(src / "*"), atlas, [1, 2, 3], out, name=name).awaitTermination(120)
    vox.filter((F.col("scan_id") == "a") & (F.col("t") >= 20)).coalesce(1).write.parquet(str(src / "a2"))
    start_incremental_extract(spark, str(src / "*"), atlas, [1, 2, 3], out, name=name).awaitTermination(120)
    got = spark.read.parquet(out).toPandas().sort_values(["scan_id", "t"]).reset_index(drop=True)
    want = extract_regions(vox, atlas, [1, 2, 3]).toPandas().sort_values(["scan_id", "t"]).reset_index(drop=True)
    assert len(got) == 80
    np.testing.assert_allclose(got[["x0", "x1", "x2"]].to_numpy(), want[["x0", "x1", "x2"]].to_numpy(), atol=1e-12)


@pytest.mark.parametrize("method", ["ols", "lasso"])
def test_cohort_scores_many_cohorts(spark, method):
    """Weights-table scoring with three cohorts against NumPy: scaler on
    train rows, fits from the train Gram, metrics per cohort and split."""
    from voxelframe.plans.modelling import cohort_scores
    rng = np.random.default_rng(31)
    cols = ["x0", "x1", "x2", "x3"]
    parts = []
    for ci, coh in enumerate(["a", "b", "c"]):
        n = 300 + 50 * ci
        lat = rng.normal(size=n)
        x = np.stack([lat * (j + 1 + ci) * 0.4 + rng.normal(size=n) for j in range(4)], axis=1)
        pdf = pd.DataFrame(x, columns=cols)
        pdf["cohort"] = coh
        pdf["split"] = np.where(np.arange(n) < int(0.7 * n), "train", "test")
        parts.append(pdf)
    pdf = pd.concat(parts, ignore_index=True)
    df = spark.createDataFrame(pdf).repartition(5)
    got = cohort_scores(df, cols, method=method, alpha=0.01).toPandas()
    assert len(got) == 3 * 4 * 2
    for coh, g in pdf.groupby("cohort"):
        tr = g[g.split == "train"]
        mu, sd = tr[cols].mean().to_numpy(), tr[cols].std(ddof=0).to_numpy()
        z = (g[cols].to_numpy() - mu) / sd
        ztr = z[(g.split == "train").to_numpy()]
        cov = ztr.T @ ztr / len(ztr)
        w = linear.lasso_all_targets(cov, 0.01) if method == "lasso" else linear.ols_all_targets(cov)
        for k, c in enumerate(cols):
            p = z @ w[k]
            for s in ("train", "test"):
                m = (g.split == s).to_numpy()
                e = z[m, k] - p[m]
                row = got[(got.cohort == coh) & (got.region == c) & (got.split == s)].iloc[0]
                assert row["n"] == m.sum()
                assert row["mse"] == pytest.approx(np.mean(e * e), rel=1e-9, abs=1e-12)
                assert row["mae"] == pytest.approx(np.mean(np.abs(e)), rel=1e-9, abs=1e-12)
                sst = np.var(z[m, k]) * m.sum()
                assert row["r2"] == pytest.approx(1 - np.sum(e * e) / sst, rel=1e-9, abs=1e-12)


def test_centred_gram_one_pass(spark):
    """Shifted one-pass covariance equals NumPy's, also when the mean is
    a million times the spread."""
    rng = np.random.default_rng(41)
    x = 1e6 + rng.normal(size=(3000, 6)) @ rng.normal(size=(6, 6))
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "v array<double>").repartition(7)
    n, mu, m2 = linear.centred_gram(df, "v", 6, shift=x[0])
    assert n == 3000
    np.testing.assert_allclose(mu, x.mean(axis=0), rtol=1e-13)
    np.testing.assert_allclose(m2 / n, np.cov(x, rowvar=False, bias=True), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("native", [True, False])
def test_gram_by_both_paths(spark, monkeypatch, native):
    """Grouped Gram per key: native aggregate and Arrow-batch path agree
    with NumPy."""
    if not native:
        monkeypatch.setattr(linear, "NATIVE_GRAM_MAX_DIM", 0)
    rng = np.random.default_rng(43)
    x = rng.normal(size=(900, 5))
    keys = np.array(["a", "b", "c"])[rng.integers(0, 3, size=900)]
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(5)])
    pdf["k"] = keys
    got = linear.gram_by(spark.createDataFrame(pdf).repartition(4), "k", [f"x{i}" for i in range(5)])
    assert set(got) == {"a", "b", "c"}
    for k in "abc":
        xs = x[keys == k]
        n, g = got[k]
        assert n == len(xs)
        np.testing.assert_allclose(g, xs.T @ xs, rtol=1e-12, atol=1e-9)

"""Confounds, caps, helpers, sinks, model persistence."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.functions.numeric import random_int, uniform_constant
from voxelframe.functions.regions import first_missing, to_long
from voxelframe.operators import formula, trees
from voxelframe.operators.confounds import high_variance_confounds
from voxelframe.operators.joins import expand_worklist, first_n_per_key, skip_done
from voxelframe.sources import files, keyed


def test_high_variance_confounds(spark):
    rng = np.random.default_rng(11)
    rows = []
    T, V = 30, 200
    for scan in ("a", "b"):
        x = rng.normal(size=(T, V))
        x[:, :8] *= 10  # a few voxels with high variance
        for v in range(V):
            for t in range(T):
                rows.append((scan, v, t, float(x[t, v])))
    pdf = pd.DataFrame(rows, columns=["scan_id", "voxel_id", "t", "value"])
    got = high_variance_confounds(spark.createDataFrame(pdf), n_confounds=3, percentile=2.0).toPandas()
    for scan, g in pdf.groupby("scan_id"):
        m = g.pivot(index="t", columns="voxel_id", values="value").to_numpy()
        var = m.var(axis=0)
        sel = m[:, var > np.percentile(var, 98)]
        tt = np.arange(T, dtype=float)
        sel = sel - np.outer(np.ones(T), sel.mean(0))
        sel = sel - np.outer(tt - tt.mean(), (sel * (tt - tt.mean())[:, None]).sum(0) / ((tt - tt.mean()) ** 2).sum())
        u = np.linalg.svd(sel, full_matrices=False)[0][:, :3]
        c = got[got.scan_id == scan].sort_values("t")[["c0", "c1", "c2"]].to_numpy()
        # same subspace: projections agree (signs are arbitrary)
        np.testing.assert_allclose(np.abs(np.sum(u * c, axis=0)), 1.0, atol=1e-8)


def test_worklist_helpers(spark):
    people = spark.createDataFrame([(1,), (2,)], "person long")
    w = expand_worklist(people, [1, 2], ["LR", "RL"])
    assert w.count() == 8
    done = spark.createDataFrame([(1, 1, "LR"), (2, 2, "RL")], "person long, session int, direction string")
    assert skip_done(w, done, ["person", "session", "direction"]).count() == 6
    capped = first_n_per_key(w, "person", ["session", "direction"], 2).toPandas()
    assert len(capped) == 4 and set(capped["session"]) == {1}
    assert first_n_per_key(w, "person", ["session"], None).count() == 8


def test_first_missing_and_long(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 3), ("b", 1), ("c", 0), ("c", 1), ("c", 1)],
                               "k string, n int")
    got = {r["k"]: r["missing"] for r in first_missing(df, ["k"], "n").collect()}
    assert got == {"a": 2, "b": 0, "c": 2}
    wide = spark.createDataFrame([(1, 0.5, 1.5)], "t long, x0 double, x1 double")
    assert sorted((r["region"], r["value"]) for r in to_long(wide, ["t"], ["x0", "x1"]).collect()) == \
        [("x0", 0.5), ("x1", 1.5)]


def test_random_helpers(spark):
    r = spark.range(2000).select(uniform_constant(1, F.col("id")).alias("c"), random_int(2, F.col("id"), low=3, high=5).alias("i")).toPandas()
    assert r["c"].between(-2, 2).all() and (r["c"].round(2) == r["c"]).all()
    assert set(r["i"]) == {3, 4, 5}
    frame = files.random_columns(spark.range(1000), ["id"], ["a", "b"], seed=3).toPandas().set_index("id")
    again = files.random_columns(spark.range(1000).repartition(7), ["id"], ["a", "b"], seed=3).toPandas().set_index("id")
    assert frame.equals(again.loc[frame.index]) and frame.min().min() >= 0 and frame.max().max() < 1
    assert abs(frame["a"].mean() - 0.5) < 0.05 and abs(frame["a"].corr(frame["b"])) < 0.1


def test_route_sink(spark, tmp_path):
    df = spark.range(20).select((F.col("id") % 2).alias("scan"), (F.col("id") / 2).cast("long").alias("t"),
                                (F.col("id") * 1.5).alias("x0"))
    files.route_sink(df, "hdd", str(tmp_path / "hdd"), "scan")
    assert sorted(os.listdir(tmp_path / "hdd"))[:2] == ["_SUCCESS", "scan=0"] or os.path.isdir(tmp_path / "hdd" / "scan=0")
    files.route_sink(df, "base", str(tmp_path / "kt"), "scan")
    view = keyed.latest(keyed.scan(spark, str(tmp_path / "kt"), dataset="HCP"))
    assert sorted((r["row_key"], r["chunk"], r["data"]["person"]) for r in view.collect()) == [
        ("HCP_0", 0, "0"), ("HCP_1", 0, "1")]
    # a second run has a higher version; fewer chunks replace more
    named = df.withColumn("person", F.col("scan") + 100)
    files.route_sink(named, "base", str(tmp_path / "kt"), "scan", person="person", atlas="other")
    rows = keyed.latest(keyed.scan(spark, str(tmp_path / "kt"))).collect()
    assert {(r["row_key"], r["data"]["person"], r["data"]["atlas"]) for r in rows} == {
        ("HCP_0", "100", "other"), ("HCP_1", "101", "other")}
    long = spark.createDataFrame([("k", 0, "a", 1), ("k", 1, "b", 1), ("k", 0, "c", 2)], "k string, n int, roi string, v int")
    two = keyed.make_rows(long, F.col("k"), F.lit("1"), F.lit("d"), F.lit("a"), F.col("roi"), F.col("v"), chunk=F.col("n"))
    assert [r["data"]["roi"] for r in keyed.latest(two).collect()] == ["c"]
    with pytest.raises(ValueError):
        files.route_sink(df, "tape", str(tmp_path / "x"), "scan")


def test_model_and_formula_persistence(spark, tmp_path):
    df = spark.range(200).select(F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("y", F.col("a") * 2)
    model, feats, va = trees.fit_region(df, ["a", "b", "y"], "y", max_iter=2)
    p = str(tmp_path / "gbt")
    trees.save_model(model, p)
    back = trees.load_model(p)
    a = trees.predict(model, va, df).select("_pred").collect()
    b = trees.predict(back, va, df).select("_pred").collect()
    assert a == b
    rows = formula.formula_rows(spark, {1: ("x0", ("add", "x1", 1.0)), 2: ("x1", ("div", "x0", "x2"))})
    fp = str(tmp_path / "formulas")
    formula.save_formulas(rows, fp)
    formula.save_formulas(rows, fp)
    assert spark.read.parquet(fp).count() == 4
    assert sorted(r["expr"] for r in rows.collect())[0].startswith("(x1 +")


def test_plain_division(spark):
    from voxelframe.functions.numeric import register_sql_functions
    register_sql_functions(spark)
    t = ("/", 1.0, ("-", 2.0, 2.0))
    assert spark.range(1).select(F.expr(formula.render(t)).alias("v")).first()["v"] is None


def test_run_extraction_end_to_end(spark, tmp_path):
    from voxelframe.plans.extract import run_extraction
    rng = np.random.default_rng(12)
    wl = tmp_path / "worklist.csv"
    pd.DataFrame({"path": [f"/data/{p}_{s}_LR.zip" for p in (100, 101) for s in (1, 2)],
                  "people_number": [100, 100, 101, 101]}).to_csv(wl, index=False)
    scans = [f"{p}_{s}_LR" for p in (100, 101) for s in (1, 2)]
    rows = [(sc, v, t, float(rng.normal())) for sc in scans for v in range(30) for t in range(25)]
    spark.createDataFrame(rows, "scan_id string, voxel_id bigint, t int, value double") \
        .write.parquet(str(tmp_path / "vox"))
    spark.createDataFrame([("harvard_oxford", v, v % 4) for v in range(30)], "atlas string, voxel_id bigint, label int") \
        .write.parquet(str(tmp_path / "atlas"))
    conf = [(sc, t, *map(float, rng.normal(size=5))) for sc in scans for t in range(25)]
    spark.createDataFrame(conf, "scan_id string, t int, c0 double, c1 double, c2 double, c3 double, c4 double") \
        .write.parquet(str(tmp_path / "conf"))
    out = str(tmp_path / "regions")
    s = run_extraction(spark, str(wl), str(tmp_path / "vox"), str(tmp_path / "atlas"), "harvard_oxford", out,
                       confounds_path=str(tmp_path / "conf"), max_per_person=1)
    got = {r["scan_id"]: r["n_timepoints"] for r in s.collect()}
    assert got == {"100_1_LR": 25, "101_1_LR": 25}
    back = spark.read.option("header", True).csv(out)
    assert sorted(back.columns) == ["scan_id", "x0", "x1", "x2"]
    # a second run into the same folder skips the scans already written
    s2 = run_extraction(spark, str(wl), str(tmp_path / "vox"), str(tmp_path / "atlas"), "harvard_oxford", out)
    assert sorted(r["scan_id"] for r in s2.collect()) == ["100_2_LR", "101_2_LR"]
    assert spark.read.option("header", True).csv(out).select("scan_id").distinct().count() == 4
    with pytest.raises(OSError):
        run_extraction(spark, str(wl), str(tmp_path / "vox"), str(tmp_path / "atlas"), "other", out)


def test_extraction_reports_every_scan(spark, tmp_path):
    """A scan without voxel rows and one with a missing confound row are
    reported and not written; the keyed table has the right identities."""
    from voxelframe.plans.extract import run_extraction
    wl = tmp_path / "worklist.csv"
    pd.DataFrame({"path": [f"/data/{p}_1_LR.zip" for p in (100, 101, 102)], "people_number": [1, 2, 3]}).to_csv(wl, index=False)
    rng = np.random.default_rng(1)
    rows = [(f"{p}_1_LR", v, t, float(rng.normal())) for p in (100, 101) for v in range(12) for t in range(20)]
    spark.createDataFrame(rows, "scan_id string, voxel_id bigint, t int, value double").write.parquet(str(tmp_path / "vox"))
    spark.createDataFrame([("toy", v, v % 3) for v in range(12)], "atlas string, voxel_id bigint, label int") \
        .write.parquet(str(tmp_path / "atlas"))
    conf = [(f"{p}_1_LR", t, *map(float, rng.normal(size=5))) for p in (100, 101) for t in range(20) if (p, t) != (101, 4)]
    spark.createDataFrame(conf, "scan_id string, t int, c0 double, c1 double, c2 double, c3 double, c4 double") \
        .write.parquet(str(tmp_path / "conf"))
    out = str(tmp_path / "kt")
    args = (spark, str(wl), str(tmp_path / "vox"), str(tmp_path / "atlas"), "toy", out)
    s = run_extraction(*args, target="base", confounds_path=str(tmp_path / "conf"))
    assert sorted((r["scan_id"], r["n_timepoints"], r["n_gaps"], r["status"], r["error"]) for r in s.collect()) == [
        ("100_1_LR", 20, 0, "ok", None), ("101_1_LR", 20, 1, "error", "time points without confounds"),
        ("102_1_LR", 0, 0, "error", "no voxel rows")]
    got = keyed.latest(keyed.scan(spark, out, atlas="toy")).collect()
    assert [(r["row_key"], r["data"]["person"], r["chunk"]) for r in got] == [("HCP_100_1_LR", "1", 0)]
    # written scans are skipped in the keyed table as well
    again = run_extraction(*args, target="base", confounds_path=str(tmp_path / "conf"))
    assert sorted(r["scan_id"] for r in again.collect()) == ["101_1_LR", "102_1_LR"]


def test_models_need_labels(spark):
    from voxelframe.plans.modelling import prepare
    regions = spark.range(60).select((F.col("id") % 3).alias("scan_id"), F.floor(F.col("id") / 3).alias("t"),
                                     (F.col("id") % 3).alias("person"), F.rand(1).alias("x0"))
    labels = spark.createDataFrame([(0, "M"), (1, "F")], "person bigint, gender string")
    with pytest.raises(KeyError):
        prepare(regions, labels, "scan_id", "t", ["x0"], "person", "gender", "M")
    loose = prepare(regions, labels, "scan_id", "t", ["x0"], "person", "gender", "M", strict=False)
    assert {r["cohort"] for r in loose.select("cohort").distinct().collect()} == {"men", "women"}


def test_broadcast_size_is_measured(spark):
    from voxelframe.operators import joins
    wide = spark.range(200).select("id", F.array_repeat(F.lit(1.5), 4000).alias("v"))
    assert not joins._fits(wide, None) or joins.BROADCAST_MAX_BYTES > 200 * 4000 * 8
    old, joins.BROADCAST_MAX_BYTES = joins.BROADCAST_MAX_BYTES, 1 << 20
    try:
        assert not joins._fits(wide, None) and joins._fits(wide.select("id"), None)
    finally:
        joins.BROADCAST_MAX_BYTES = old


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace
    from voxelframe.session import checkpoint_dir
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                          sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(ValueError):
        checkpoint_dir(far)


def test_high_variance_confounds_on_the_time_side(spark):
    """More selected voxels than time points: the time x time matrix."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20, 400)) * rng.uniform(0.5, 3, 400)
    pdf = pd.DataFrame([("s", v, t, x[t, v]) for v in range(400) for t in range(20)], columns=["scan_id", "voxel_id", "t", "value"])
    got = high_variance_confounds(spark.createDataFrame(pdf), percentile=20.0).toPandas().sort_values("t")
    var = x.var(0)
    sel = x[:, var > np.percentile(var, 80)]
    tt = np.arange(20) - 9.5
    sel = sel - sel.mean(0) - np.outer(tt, tt @ sel / (tt @ tt))
    u = np.linalg.svd(sel, full_matrices=False)[0]
    for k in range(5):
        assert abs(got[f"c{k}"].to_numpy() @ u[:, k]) == pytest.approx(1.0, abs=1e-8)


def scan_vectors(x, keep, n):
    """NumPy's leading time vectors of the detrended series of the kept voxels."""
    sel, tt = x[:, keep], np.arange(len(x)) - (len(x) - 1) / 2
    sel = sel - sel.mean(0) - np.outer(tt, tt @ sel / (tt @ tt))
    return np.linalg.svd(sel, full_matrices=False)[0][:, :n]


def test_high_variance_confounds_by_the_size_of_each_scan(spark, monkeypatch):
    """Scans small in time, small in voxels and large on both sides together;
    the large ones in tiles, with noise, a dominant component, and low rank."""
    from voxelframe.operators import subspace
    monkeypatch.setattr(subspace, "TILE", 16)
    rng = np.random.default_rng(5)
    scans = {s: rng.normal(size=n) * rng.uniform(0.5, 3, n[1]) for s, n in
             {"noise": (50, 90), "few times": (12, 90), "few voxels": (80, 9)}.items()}
    scans["dominant"] = rng.normal(size=(60, 40)) + 300 * np.outer(rng.normal(size=60), rng.normal(size=40))
    scans["low rank"] = rng.normal(size=(45, 2)) @ rng.normal(size=(2, 50))
    pdf = pd.concat([pd.DataFrame({"scan_id": s, "voxel_id": np.tile(np.arange(x.shape[1]), len(x)),
                                   "t": np.repeat(np.arange(len(x)), x.shape[1]), "value": x.ravel()}) for s, x in scans.items()])
    got = high_variance_confounds(spark.createDataFrame(pdf), percentile=100.0, max_side=20, n_confounds=3).toPandas()
    for s, x in scans.items():
        want = scan_vectors(x, x.var(0) > x.var(0).min(), 3)
        found = got[got.scan_id == s].sort_values("t")[["c0", "c1", "c2"]].to_numpy(float)
        if s == "low rank":
            assert np.isnan(found[:, 2]).all()
            want, found = want[:, :2], found[:, :2]
        np.testing.assert_allclose(np.abs(found), np.abs(want), atol=1e-7)


def test_tiles_refuse_missing_cells(spark):
    from voxelframe.operators import subspace
    cells = spark.createDataFrame([(1, i, j, 1.0) for i in range(5) for j in range(4) if (i, j) != (3, 2)],
                                  "s int, i long, j long, v double")
    with pytest.raises(Exception, match="missing or repeated"):
        subspace.tiles_of(cells, ["s"], "i", "j", "v", tile=4).collect()
    edge = spark.createDataFrame([(1, i, j, 1.0) for i in range(5) for j in range(4) if not (i == 4 and j == 3)],
                                 "s int, i long, j long, v double")
    with pytest.raises(Exception, match="edge of a tile"):
        subspace.tiles_of(edge, ["s"], "i", "j", "v", tile=4).collect()


def test_tournament_select(spark):
    fit = spark.createDataFrame([(i, float((i * 7) % 11)) for i in range(50)], "formula_id long, fitness double")
    w = formula.tournament_select(fit, n_slots=200, k=5, seed=1).toPandas()
    assert len(w) == 200 and w["slot"].nunique() == 200
    # winners are better than the average contestant
    assert w["fitness"].mean() < 5.0 * 0.8
    w2 = formula.tournament_select(fit.repartition(7), n_slots=200, k=5, seed=1).toPandas()
    assert w.sort_values("slot")["formula_id"].tolist() == w2.sort_values("slot")["formula_id"].tolist()
    one = formula.tournament_select(fit, n_slots=30, k=50, seed=2).toPandas()
    assert one["fitness"].max() <= 1.0


def test_label_lookup_strict(spark):
    from voxelframe.operators.joins import label_lookup, unmatched
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "person long, v string")
    labels = spark.createDataFrame([(1, "M"), (2, "F")], "person long, gender string")
    assert label_lookup(rows, labels, "person").count() == 2
    assert [r["person"] for r in unmatched(rows, labels, "person").collect()] == [3]
    with pytest.raises(KeyError):
        label_lookup(rows, labels, "person", strict=True)


def test_exact_size_split(spark):
    import math
    from voxelframe.operators.split import exact_size_split
    for n in (1, 10, 997, 5000):
        df = spark.range(n).repartition(7)
        s = exact_size_split(df, ["id"], 0.3, seed=4).toPandas()
        assert (s["split"] == "test").sum() == math.ceil(0.3 * n)
    a = exact_size_split(spark.range(997), ["id"], 0.3, seed=4).toPandas().sort_values("id")
    b = exact_size_split(spark.range(997).repartition(3), ["id"], 0.3, seed=4).toPandas().sort_values("id")
    assert list(a["split"]) == list(b["split"])


def test_csv_headers_in_any_order(spark, tmp_path):
    d = tmp_path / "roi"
    d.mkdir()
    pd.DataFrame({"x0": [1.0, 2.0], "x1": [10.0, 20.0]}).to_csv(d / "100_1.csv", index=False)
    pd.DataFrame({"x1": [30.0, 40.0, 50.0], "x0": [3.0, 4.0, 5.0]}).to_csv(d / "101_1.csv", index=False)
    df = files.read_region_csvs_any_order(spark, str(d)).toPandas().sort_values(["person", "t"])
    assert list(df["x0"]) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert list(df["x1"]) == [10.0, 20.0, 30.0, 40.0, 50.0]
    assert list(df["t"]) == [0, 1, 0, 1, 2]


def test_trees_all_regions(spark):
    df = spark.range(300).select(F.rand(1).alias("a"), F.rand(2).alias("b")) \
        .withColumn("c", F.col("a") + F.col("b")) \
        .withColumn("split", F.when(F.rand(3) < 0.3, "test").otherwise("train"))
    imp, sc = trees.fit_all_regions(df, ["a", "b", "c"], max_iter=3, split_col="split")
    assert imp.count() == 6 and sc.count() == 6
    c = {r["split"]: r["r2"] for r in sc.filter(F.col("region") == "c").collect()}
    assert c["train"] > 0.5


def test_exact_size_split_many_sizes(spark):
    import math
    from voxelframe.operators.split import exact_size_split
    for n in (2, 3, 7, 101, 1234, 3333):
        s = exact_size_split(spark.range(n), ["id"], 0.37, seed=n).toPandas()
        assert (s["split"] == "test").sum() == math.ceil(0.37 * n), n


def test_values_at_ranks(spark):
    from voxelframe.operators.aggregates import values_at_ranks
    rng = np.random.default_rng(13)
    x = np.round(rng.normal(size=5000), 2)   # many ties
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    ranks = [0, 1, 17, 2499, 2500, 4998, 4999]
    got = values_at_ranks(df, {"x": ranks}, bins=16, max_candidates=40)
    srt = np.sort(x)
    for r in ranks:
        assert got[("x", r)] == srt[r]


def test_values_at_ranks_when_the_sketch_is_off(spark):
    """Grid values far from a rank, infinite values, one value for all rows,
    and ranges of more values than the driver takes."""
    from voxelframe.operators.aggregates import values_at_ranks
    x = np.concatenate([np.arange(3000) / 7, [-np.inf, np.inf, np.inf]])
    df = spark.createDataFrame(pd.DataFrame({"x": np.random.default_rng(1).permutation(x), "one": 2.5})).repartition(5)
    srt, n = np.sort(x), len(x)
    for shift in (-900, 0, 900):
        cuts = [float(srt[min(n - 1, max(0, int(g / 1000 * n) + shift))]) for g in range(1001)]
        for most in (5, 20_000):
            got = values_at_ranks(df, {"x": [0, 1, 2, 700, 1500, 2999, n - 2, n - 1]}, max_candidates=most,
                                  grids={"x": (n, -np.inf, np.inf, cuts)})
            assert got == {("x", r): srt[r] for _, r in got}
    assert values_at_ranks(df, {"one": [0, 1500, n - 1], "x": [1]}) == {
        ("one", 0): 2.5, ("one", 1500): 2.5, ("one", n - 1): 2.5, ("x", 1): 0.0}
    with pytest.raises(ValueError):
        values_at_ranks(df, {"x": [n]})


def test_command_line_jobs(spark, tmp_path):
    from voxelframe.__main__ import run
    rng = np.random.default_rng(17)
    rows = []
    for scan, person in (("a1", 1), ("a2", 1), ("b1", 2), ("c1", 3)):
        latent = rng.normal(size=60)
        for t in range(60):
            rows.append((scan, person, t, *[float(latent[t] * (i + 1) + rng.normal()) for i in range(4)]))
    regions = spark.createDataFrame(rows, "scan_id string, person long, t long, x0 double, x1 double, x2 double, x3 double")
    rp = str(tmp_path / "regions")
    regions.write.parquet(rp)
    lab = tmp_path / "labels.csv"
    lab.write_text("person,gender\n1,M\n2,F\n3,M\n")
    out = str(tmp_path / "scores")
    run(["models", "--regions", rp, "--labels", str(lab), "--out", out], spark=spark)
    sc = spark.read.parquet(out).toPandas()
    assert set(sc["cohort"]) == {"men", "women"} and set(sc["region"]) == {"x0", "x1", "x2", "x3"}
    assert (sc[(sc.cohort == "men") & (sc.split == "train")]["r2"] > 0.5).all()
    fo = str(tmp_path / "formulas")
    run(["formulas", "--regions", rp, "--target", "x3", "--out", fo, "--population", "20",
         "--generations", "2", "--tournament", "3"], spark=spark)
    assert spark.read.parquet(fo).count() == 1

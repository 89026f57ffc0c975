"""Failure boundary per scan; all-or-nothing runs of per-scan files."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators.guarded import guarded_groups, guarded_rows
from voxelframe.sources import committed, files


def test_a_failing_scan_becomes_an_error_row(spark):
    """A singular and a malformed scan, one that is too long, one without a
    name and one without results; the others are fitted."""
    def fit(frame):
        if frame["y"].isna().any():
            raise ValueError("a value is missing")
        x = np.column_stack([np.ones(len(frame)), frame["x"]])
        b = np.linalg.solve(x.T @ x, x.T @ frame["y"])
        return pd.DataFrame({"term": ["a", "b"], "coef": b})

    rng = np.random.default_rng(2)
    rows = [(s, i, float(rng.normal()), 0.0) for s in ("good", "other", None) for i in range(30)]
    rows = [(s, i, x, 2 * x + 1) for s, i, x, _ in rows]
    rows += [("singular", i, 0.0, 1.0) for i in range(5)] + [("malformed", i, float(i), None) for i in range(4)]
    rows += [("long", i, float(i), 1.0) for i in range(200)] + [("silent", 0, 1.0, -5.0)]
    df = spark.createDataFrame(rows, "scan string, i int, x double, y double")

    def once(frame):
        assert list(frame["i"]) == sorted(frame["i"])
        return pd.DataFrame(columns=["term", "coef"]) if frame["scan"].iloc[0] == "silent" else fit(frame)
    found, status = guarded_groups(df, ["scan"], once, "term string, coef double", order_by=["i"], max_rows=100)
    got = {(r["scan"], r["term"]): r["coef"] for r in found.collect()}
    assert set(got) == {(s, c) for s in ("good", "other", None) for c in "ab"}
    assert got[("good", "a")] == pytest.approx(1) and got[(None, "b")] == pytest.approx(2)
    state = {r["scan"]: (r["status"], r["error"]) for r in status.collect()}
    assert state == {"good": ("ok", None), "other": ("ok", None), None: ("ok", None), "silent": ("ok", None),
                     "singular": ("error", "LinAlgError: Singular matrix"), "malformed": ("error", "ValueError: a value is missing"),
                     "long": ("error", "ValueError: a scan of 200 rows, more than 100")}
    # wrong result columns are that scan's error too; no scans give no rows
    _, wrong = guarded_groups(df.filter("scan = 'good'"), ["scan"], lambda f: f[["x"]], "term string, coef double")
    assert wrong.first()["status"] == "error" and "KeyError" in wrong.first()["error"]
    none, status = guarded_groups(df.limit(0), ["scan"], fit, "term string, coef double")
    assert none.count() == status.count() == 0


def test_guarded_statistics(spark):
    stats = spark.createDataFrame([("a", 4.0), ("b", 0.0), ("c", None)], "scan string, s double")

    def halves(r):
        return [{"k": k, "v": float(k / r["s"])} for k in (1, 2)]
    found, status = guarded_rows(stats, ["scan"], halves, "k int, v double")
    assert sorted(map(tuple, found.filter("scan = 'a'").collect())) == [("a", 1, 0.25), ("a", 2, 0.5)]
    state = {r["scan"]: r["status"] for r in status.collect()}
    assert state["a"] == "ok" and state["b"] == "error" and len(state) == 3
    assert "ZeroDivisionError" in status.filter("scan = 'b'").first()["error"]


def test_extraction_goes_on_after_a_failing_scan(spark, tmp_path):
    from voxelframe.plans.extract import run_extraction
    scans = [f"{p}_1_LR" for p in (100, 101, 102)]
    wl = tmp_path / "worklist.csv"
    pd.DataFrame({"path": [f"/data/{s}.zip" for s in scans], "people_number": [1, 2, 3]}).to_csv(wl, index=False)
    rng = np.random.default_rng(1)
    rows = [(s, v, t, float(rng.normal())) for s in scans for v in range(6) for t in range(10)]
    spark.createDataFrame(rows, "scan_id string, voxel_id bigint, t int, value double").write.parquet(str(tmp_path / "vox"))
    spark.createDataFrame([("toy", v, v % 3) for v in range(6)], "atlas string, voxel_id bigint, label int") \
        .write.parquet(str(tmp_path / "atlas"))
    out = str(tmp_path / "runs")

    def clean(frame):
        if frame["scan_id"].iloc[0].startswith("101"):
            raise RuntimeError("no baseline")
        return frame.assign(x0=frame["x0"] * 2)
    args = (spark, str(wl), str(tmp_path / "vox"), str(tmp_path / "atlas"), "toy", out)
    s = run_extraction(*args, target="runs", run="one", per_scan=clean)
    assert sorted((r["scan_id"], r["n_timepoints"], r["status"], r["error"]) for r in s.collect()) == [
        (scans[0], 10, "ok", None), (scans[1], 10, "error", "RuntimeError: no baseline"), (scans[2], 10, "ok", None)]
    plain = run_extraction(*args[:5], str(tmp_path / "plain"), target="hdd")
    assert plain.filter("status = 'ok'").count() == 3
    got = committed.read_runs(spark, out, "x0 double, x1 double").toPandas()
    assert set(got["scan"]) == {scans[0], scans[2]} and len(got) == 20
    want = files.read_region_csvs(spark, str(tmp_path / "plain") + "/*/*.csv", "x0 double, x1 double").toPandas()
    assert sorted(got["x0"] / 2) == pytest.approx(sorted(want[~want["_file_path"].str.contains("101_1")]["x0"]))
    # written scans are skipped, the failed one is tried again
    again = run_extraction(*args, target="runs", run="two", per_scan=lambda f: f)
    assert [r["scan_id"] for r in again.collect()] == [scans[1]]
    assert committed.current(spark, out).count() == 3


def scans(spark, n, add=0.0):
    return spark.range(n * 20).select((F.col("id") % n).alias("scan"), F.floor(F.col("id") / n).alias("t"),
                                      (F.col("id") + add).cast("double").alias("x0"), F.lit(None).cast("double").alias("x1"))


def listed(folder):
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def test_a_run_is_visible_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "out")
    assert committed.manifests(spark, path).count() == 0 and committed.read_runs(spark, path, "x0 double, x1 double").count() == 0

    def breaks(it):
        for pdf in it:
            if (pdf["scan"] == 3).any():
                raise RuntimeError("killed on purpose")
            yield pdf
    # some scans are written before one task dies: none can be seen
    broken = scans(spark, 8).mapInPandas(breaks, "scan bigint, t bigint, x0 double, x1 double")
    with pytest.raises(Exception, match="killed on purpose"):
        committed.write_run(broken, path, "first", "scan")
    assert committed.current(spark, path).count() == 0
    assert [f for f in listed(os.path.join(path, committed.MANIFESTS)) if f.endswith(".json")] == []
    # the same run, repeated, is there once
    committed.write_run(scans(spark, 8), path, "first", "scan")
    files_then = listed(os.path.join(path, committed.DATA))
    committed.write_run(scans(spark, 8, add=0.5), path, "first", "scan")
    assert listed(os.path.join(path, committed.DATA)) == files_then
    rows = committed.read_runs(spark, path, "x0 double, x1 double")
    assert sorted((int(r["scan"]), r["t"], r["x0"], r["x1"]) for r in rows.collect()) == sorted(
        (r["scan"], r["t"], r["x0"], None) for r in scans(spark, 8).collect())
    # a later run replaces the scans it holds
    committed.write_run(scans(spark, 8, add=0.25).filter("scan < 2"), path, "second", "scan")
    state = {r["scan"]: (r["run"], r["rows"]) for r in committed.current(spark, path).collect()}
    assert state == {str(s): ("second" if s < 2 else "first", 20) for s in range(8)}
    halves = committed.read_runs(spark, path, "x0 double, x1 double").filter("x0 % 1 = 0.25")
    assert {r["scan"] for r in halves.select("scan").distinct().collect()} == {"0", "1"}
    # an empty run is a run
    committed.write_run(scans(spark, 8).limit(0), path, "third", "scan")
    assert "third.json" in listed(os.path.join(path, committed.MANIFESTS))
    for name in ("", "a/b", ".hidden"):
        with pytest.raises(ValueError):
            committed.write_run(scans(spark, 1), path, name, "scan")


def test_scans_of_two_tasks_in_one_run_are_an_error(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.dataSource.register(committed.CommittedScans)
    rows = scans(spark, 2).withColumn("scan", F.col("scan").cast("string")).repartition(2, "t").sortWithinPartitions("scan")
    (rows.write.format(committed.FORMAT).mode("append").option("path", path).option("run", "r").option("key", "scan")
         .option("drop", "t").save())
    with pytest.raises(Exception, match="several files of one run"):
        committed.current(spark, path).collect()

"""Keyed table, work-lists, per-scan CSVs, archives, sinks, voxel sources."""

import io
import os
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.functions.json_cells import from_cells, to_cells
from voxelframe.sources import files, keyed, voxel


def test_keyed_table(spark, tmp_path):
    path = str(tmp_path / "kt")
    keyed.create_table(spark, path)
    rows = []
    for i, key in enumerate(["HCP_100_1", "HCP_100_2", "HCP_101_1", "row-1", "row-2"]):
        for v in (1, 2):
            rows.append((key, f"{key}-v{v}", v + 10 * i))
    src = spark.createDataFrame(rows, "k string, roi string, v long")
    keyed.put(keyed.make_rows(src, F.col("k"), F.lit("100"), F.lit("HCP"), F.lit("harvard_oxford"),
                              F.col("roi"), F.col("v")), path)
    # a retried put of the same rows is harmless
    keyed.put(keyed.make_rows(src, F.col("k"), F.lit("100"), F.lit("HCP"), F.lit("harvard_oxford"),
                              F.col("roi"), F.col("v")), path)
    tomb_path = str(tmp_path / "tomb")
    keyed.delete(spark, spark.createDataFrame([("row-1",), ("HCP_101_1",)], "row_key string"),
                 F.lit(31), tomb_path)
    view = keyed.latest(keyed.scan(spark, path, dataset="HCP", atlas="harvard_oxford"),
                        spark.read.schema(keyed.TOMBSTONE_SCHEMA).parquet(tomb_path))
    got = {r["row_key"]: r["data"]["roi"] for r in view.collect()}
    # row-1 (versions 31, 32): newest put 32 > delete 31 -> kept; HCP_101_1 (21, 22) deleted
    assert got == {"HCP_100_1": "HCP_100_1-v2", "HCP_100_2": "HCP_100_2-v2", "row-1": "row-1-v2",
                   "row-2": "row-2-v2"}
    assert [r["row_key"] for r in keyed.get(view, "row-2").collect()] == ["row-2"]
    assert sorted(r["row_key"] for r in keyed.multi_get(view, ["row-1", "row-2", "zzz"]).collect()) == ["row-1", "row-2"]
    assert sorted(r["row_key"] for r in keyed.prefix_scan(view, "HCP_100").collect()) == ["HCP_100_1", "HCP_100_2"]
    keys = spark.createDataFrame([("row-2",), ("HCP_100_1",)], "row_key string")
    assert sorted(r["row_key"] for r in keyed.multi_get(view, keys).collect()) == ["HCP_100_1", "row-2"]
    # filters reach the Parquet scan
    plan = keyed.scan(spark, path).filter(F.col("row_key").startswith("HCP"))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key,HCP)" in plan


def test_json_cells_roundtrip(spark):
    pdf = pd.DataFrame({"scan": ["a"] * 12 + ["b"] * 3, "t": list(range(12)) + [0, 1, 2],
                        "x0": np.arange(15) * 0.5, "x1": [None] * 2 + list(np.arange(13) * 1.25)})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "scan string, t long, x0 double, x1 double")
    cells = to_cells(df, ["scan"], "t", ["x0", "x1"], cell_rows=5)
    assert cells.count() == 4  # a: 0-4, 5-9, 10-11; b: 0-2
    first = cells.filter((F.col("scan") == "a") & (F.col("chunk") == 0)).first()["roi"]
    assert first.startswith('{"x0":{"0":0.0,"1":0.5,')
    back = from_cells(cells, ["scan"]).toPandas()
    x0 = back[back.column == "x0"].sort_values(["scan", "t"])
    assert list(x0["value"]) == list(pdf["x0"])
    a10 = cells.filter((F.col("scan") == "a") & (F.col("chunk") == 2)).first()["roi"]
    assert '"10":5.0' in a10 and a10.index('"10"') < a10.index('"11"')


def test_region_csvs(spark, tmp_path):
    d = tmp_path / "roi"
    d.mkdir()
    rng = np.random.default_rng(0)
    lens = {"100307_1.csv": 5, "100307_2.csv": 200, "100408_1.csv": 11}
    for name, n in lens.items():
        pd.DataFrame(rng.normal(size=(n, 3)), columns=["x0", "x1", "x2"]).to_csv(d / name, index=False)
    df = files.read_region_csvs(spark, str(d), schema="x0 double, x1 double, x2 double")
    pdf = df.toPandas()
    assert len(pdf) == sum(lens.values())
    for name, n in lens.items():
        g = pdf[pdf.file == name].sort_values("t")
        assert list(g["t"]) == list(range(n))
        want = pd.read_csv(d / name)
        np.testing.assert_allclose(g[["x0", "x1", "x2"]].to_numpy(), want.to_numpy())
    assert set(pdf["person"]) == {100307, 100408}
    # a header in another order fails loudly instead of binding by position
    pd.DataFrame({"x1": [1.0], "x0": [2.0], "x2": [3.0]}).to_csv(d / "100500_1.csv", index=False)
    with pytest.raises(Exception):
        files.read_region_csvs(spark, str(d), schema="x0 double, x1 double, x2 double").collect()
    assert files.count_files(spark, str(d / "*.csv")) == 4


def test_write_per_scan(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 3).alias("scan"), (F.col("id") / 3).cast("long").alias("t"),
                                 (F.col("id") * 0.5).alias("x0"))
    out = str(tmp_path / "out")
    files.write_per_scan(df.repartition(7), out, "scan")
    for s in range(3):
        parts = [f for f in os.listdir(os.path.join(out, f"scan={s}")) if f.endswith(".csv")]
        assert len(parts) == 1
        back = pd.read_csv(os.path.join(out, f"scan={s}", parts[0]))
        assert list(back.columns) == ["x0"]
        assert list(back["x0"]) == sorted(back["x0"])


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for m in members:
            z.writestr(m, b"data")
    path.write_bytes(buf.getvalue())


def test_archive_listing(spark, tmp_path):
    base = tmp_path / "arch"
    base.mkdir()
    _zip(base / "100307_3T_rfMRI_REST1_fixextended.zip", [
        "100307/MNINonLinear/Results/rfMRI_REST1_LR/rfMRI_REST1_LR.nii.gz",
        "100307/MNINonLinear/Results/rfMRI_REST1_RL/rfMRI_REST1_RL.nii.gz",
        "100307/MNINonLinear/Results/rfMRI_REST1_LR/other.txt",
        "100307/MNINonLinear/Results/rfMRI_REST2_LR/rfMRI_REST2_LR.nii.gz"])
    _zip(base / "100408_3T_rfMRI_REST2_fixextended.zip", [
        "100408/MNINonLinear/Results/rfMRI_REST2_LR/rfMRI_REST2_LR.nii.gz"])
    (base / "100500_3T_rfMRI_REST1_fixextended.zip").write_bytes(b"not a zip")
    listing = files.list_archive_members(spark, str(base / "*.zip"))
    st = {r["status"]: r["count"] for r in listing.groupBy("status").count().collect()}
    assert st == {"ok": 5, "error": 1}
    by_content = files.list_archive_members(spark, str(base / "*.zip"), read_content=True)
    assert sorted(map(tuple, by_content.select("member", "status").collect()), key=str) == \
        sorted(map(tuple, listing.select("member", "status").collect()), key=str)
    keep = files.rest_run_members(listing).select("person", "rest", "member").collect()
    assert sorted((r["person"], r["rest"]) for r in keep) == [(100307, "REST1"), (100307, "REST1"), (100408, "REST2")]


def test_atlas_lookup(spark, tmp_path):
    p = str(tmp_path / "atlas")
    spark.createDataFrame([("harvard_oxford", i, i % 4) for i in range(20)], voxel.ATLAS_SCHEMA).write.parquet(p)
    assert voxel.read_atlas(spark, p, "harvard_oxford").count() == 20
    with pytest.raises(OSError):
        voxel.read_atlas(spark, p, "no_such_atlas")


def test_small_table_literal_and_shipped_paths(spark, monkeypatch):
    """Bounded driver results: literals in the plan and shipped rows give
    the same table (types, nulls, NaN, arrays, NumPy scalars)."""
    import math

    import numpy as np

    from voxelframe import tables
    rows = [("a", 1, 2.5, [1.0, 2.0], None), ("b", np.int64(2), np.float64("nan"), [], "x"),
            (None, 3, None, None, "y")]
    schema = "k string, n bigint, v double, w array<double>, s string"
    lit = tables.small_table(spark, rows, schema)
    monkeypatch.setattr(tables, "INLINE_ROWS", 0)
    shipped = tables.small_table(spark, [(r[0], int(r[1]), None if r[2] is None else float(r[2]), r[3], r[4])
                                         for r in rows], schema)
    assert lit.schema.simpleString() == shipped.schema.simpleString()
    assert "Generate" in lit._jdf.queryExecution().executedPlan().toString()

    def norm(df):
        return sorted([tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r)
                       for r in df.collect()], key=str)
    assert norm(lit) == norm(shipped)

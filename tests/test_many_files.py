"""Folders of many small files and archives; slices without barrier calls."""

import io
import os
import shutil
import time
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import net
from voxelframe.plans.q_sources import zip_bytes
from voxelframe.sources import files, scan_files

ODD = [("a/b", 1, 1.5, "x"), ("a/b", 0, None, None), ("", 0, 1e-10, ""), (None, 1, 1e10, 'q"uo,te\nnl'), ("c=d", 0, float("nan"), " sp "),
       ("c=d", None, float("inf"), "ä#'"), ("z", 0, -0.0, "\\back"), ("z", 2, 1.0, "  "), ("z", 1, 123456789.123, "'")]


def contents(folder):
    return {d: [open(os.path.join(folder, d, f), newline="", encoding="utf-8").read() for f in os.listdir(os.path.join(folder, d))
                if f.endswith(".csv")] for d in os.listdir(folder) if "=" in d}


def test_files_are_those_of_sparks_writer(spark, tmp_path):
    df = spark.createDataFrame(ODD, "k string, t int, x double, `s,1` string").repartition(3)
    for name, cols in (("both", ["x", "`s,1`"]), ("x", ["x"]), ("s", ["`s,1`"])):
        d = df.select("k", "t", *cols)
        files.write_per_scan(d, str(tmp_path / name), "k")
        (d.repartition(1).sortWithinPartitions("k", "t").drop("t").write.partitionBy("k").option("header", True)
          .csv(str(tmp_path / f"spark_{name}")))
        assert contents(tmp_path / name) == contents(tmp_path / f"spark_{name}")
        # no scan after scan is moved on the driver: nothing of Spark's committer is there
        assert not [f for _, _, fs in os.walk(tmp_path / name) for f in fs if f.endswith(".crc")]


def test_scans_are_replaced_or_added_to(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(s, t, float(s)) for s in range(3) for t in range(2)], "scan int, t int, x double")
    files.write_per_scan(df, out, "scan")
    files.write_per_scan(df.filter("scan = 1").withColumn("x", F.lit(9.0)), out, "scan")
    assert contents(out) == {"scan=0": ["x\n0.0\n0.0\n"], "scan=1": ["x\n9.0\n9.0\n"], "scan=2": ["x\n2.0\n2.0\n"]}
    files.write_per_scan(df.filter("scan = 2"), out, "scan", mode="append")
    assert [len(v) for _, v in sorted(contents(out).items())] == [1, 1, 2]
    assert not [f for f in os.listdir(out) if f.startswith(".drafts")]
    (tmp_path / "out" / "scan=0" / "note.txt").write_text("n")
    assert files.count_files(spark, out + "/*/*.csv") == 4 and files.count_files(spark, out + "/scan=[02]/*") == 4
    assert files.count_files(spark, out + "/*") == 5
    files.write_per_scan(df.limit(0), str(tmp_path / "none"), "scan")
    assert contents(tmp_path / "none") == {}


def test_folders_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "f.csv").write_text("x\n1\n")
    loaded = []
    from pyspark.sql.readwriter import DataFrameReader
    load = DataFrameReader.load
    monkeypatch.setattr(DataFrameReader, "load", lambda self, path=None, *a, **k: (loaded.append(path), load(self, path, *a, **k))[1])
    assert files.count_files(spark, str(tmp_path / "*" / "*.csv")) == 3
    assert loaded == [str(tmp_path)]


def test_small_files_are_opened_once(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}_1.csv").write_text("x\n" + "".join(f"{i}{k}\n" for k in range(9)))
    found = files.read_region_csvs(spark, str(tmp_path), schema="x double")
    assert "file_size" in found._jdf.queryExecution().executedPlan().toString()      # the counts' listing leaves them out
    whole = found.collect()
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10")
    try:
        split = files.read_region_csvs(spark, str(tmp_path), schema="x double")
        rows = [sorted((r["file"], r["t"], r["x"]) for r in d) for d in (whole, split.collect())]
        with pytest.raises(Exception, match="a file was cut"):
            found.select("file", "t").collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows[0] == rows[1] == [(f"{i}_1.csv", k, float(f"{i}{k}")) for i in range(4) for k in range(9)]


def test_lines_in_any_order_are_read_once(spark, tmp_path):
    d = tmp_path / "roi"
    d.mkdir()
    (d / "1_1.csv").write_text("x0,x1\n1,2\n")
    (d / "2_1.csv").write_text("x1,x0\n3,4\n")
    found = files.read_region_csvs_any_order(spark, str(d))
    shutil.move(str(d), str(tmp_path / "gone"))
    assert sorted((r["person"], r["x0"], r["x1"]) for r in found.collect()) == [(1, 1.0, 2.0), (2, 4.0, 3.0)]


def test_small_region_files_fill_the_cores(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.csv").write_text(f"x\n{i}\n")
    found = scan_files.read_region_files(spark, str(tmp_path / "*.csv"), "x double")
    assert found.rdd.getNumPartitions() >= 4
    assert sorted(r["x"] for r in found.collect()) == list(range(40))


def test_zip_bytes_is_what_zipfile_reads(spark):
    for names, sizes in (([], []), (["a", "ä/b", "a"], [0, 3, 5]), ([f"m{i}" for i in range(70_000)], [1] * 70_000)):
        with zipfile.ZipFile(io.BytesIO(zip_bytes(names, np.array(sizes)))) as z:
            assert [(i.filename, i.file_size) for i in z.infolist()] == list(zip(names, sizes))
            assert len(names) > 9 or z.testzip() is None and [z.read(i) for i in z.infolist()] == [b"x" * s for s in sizes]


def test_archives_are_planned_by_folder(spark, tmp_path):
    for k in range(200):
        (tmp_path / f"d{k % 40}").mkdir(exist_ok=True)
        (tmp_path / f"d{k % 40}" / f"a{k}.zip").write_bytes(zip_bytes(["m", "n"], [k, 1]) if k else b"no archive")
    (tmp_path / "d0" / "a.zip").mkdir()
    found = scan_files.read_archive_members(spark, str(tmp_path / "*" / "*.zip"))
    assert 4 <= found.rdd.getNumPartitions() <= 16          # not a partition for so many files
    old = scan_files.read_archive_members(spark, str(tmp_path / "*" / "*.zip"), partition_files=64)
    want = sorted(map(str, old.collect()))
    assert sorted(map(str, found.collect())) == want and len(want) == 399
    flat = scan_files.read_archive_members(spark, str(tmp_path / "d1" / "*.zip"))
    assert flat.count() == 10
    assert scan_files.read_archive_members(spark, str(tmp_path / "none*" / "*.zip")).count() == 0


def test_slices_do_not_wait_for_barrier_calls(spark, monkeypatch):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(800, 2)), columns=["a", "b"])
    pdf["rid"], pdf["split"] = np.arange(800), "train"
    d = spark.createDataFrame(pdf)
    nets = {c: net.init_net(np.random.default_rng(1), 1, (3, 2)) for c in "ab"}
    net.train_synchronous(d, ["a", "b"], nets, ["rid"], 1, batch_rows=400, tasks=4)
    start = time.monotonic()
    found, hist = net.train_synchronous(d, ["a", "b"], nets, ["rid"], 2, batch_rows=20, tasks=4)
    assert time.monotonic() - start < 60                    # 80 slices took 80 seconds and more
    few = d.limit(40).localCheckpoint()
    want = net.train_synchronous(few, ["a", "b"], nets, ["rid"], 2, batch_rows=20, tasks=2)
    monkeypatch.setattr("voxelframe.session.mounted_folder", lambda spark, path: None)      # a remote store
    got = net.train_synchronous(few, ["a", "b"], nets, ["rid"], 2, batch_rows=20, tasks=2)
    assert [h[4] for h in got[1]] == pytest.approx([h[4] for h in want[1]], rel=1e-9)

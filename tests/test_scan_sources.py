"""Data sources of per-scan files and archives; the compacted keyed layout."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from voxelframe.sources import compacted, files, keyed, scan_files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_region_files(spark, tmp_path):
    (tmp_path / "a_1.csv").write_text("x0,x1\n1,2\n3,\n")
    (tmp_path / "b_1.csv").write_text("x1,x0\n5,4\n")               # another order
    (tmp_path / "c_1.csv").write_text("x1\n7\n")                    # a column short
    (tmp_path / "d_1.csv").write_text("x0,x1\n")                    # no rows
    damaged = {"empty": ("", "no header"), "word": ("x0,x1\n1,2\n1,two\n", "could not convert"), "short": ("x0,x1\n1\n", "1 values for 2"),
               "other": ("x0,y\n1,2\n", "unknown columns"), "twice": ("x0,x0\n1,2\n", "twice"), "quote": ('x0,x1\n"1,2\n', "")}
    for name, (text, _) in damaged.items():
        (tmp_path / f"{name}.csv").write_text(text)
    (tmp_path / "binary.csv").write_bytes(b"x0,x1\n\xff\xfe,1\n")
    found = scan_files.read_region_files(spark, str(tmp_path / "*.csv"), "x0 double, x1 double", partition_bytes=20)
    assert found.rdd.getNumPartitions() > 3                         # planned by file
    rows = found.collect()
    assert sorted((r["scan"], r["t"], r["x0"], r["x1"]) for r in rows if r["status"] == "ok") == [
        ("a_1", 0, 1.0, 2.0), ("a_1", 1, 3.0, None), ("b_1", 0, 4.0, 5.0), ("c_1", 0, None, 7.0)]
    errors = {r["scan"]: r["error"] for r in rows if r["status"] == "error"}
    assert set(errors) == {*damaged, "binary"} and all(text in errors[n] for n, (_, text) in damaged.items())
    assert scan_files.read_region_files(spark, str(tmp_path / "none*.csv"), "x0 double").count() == 0
    # the files that both readers take give the same rows
    old = files.read_region_csvs_any_order(spark, str(tmp_path / "[abc]_1.csv"))
    assert sorted((r["file"][:-4], r["t"], r["x0"], r["x1"]) for r in old.collect()) == sorted(
        (r["scan"], r["t"], r["x0"], r["x1"]) for r in rows if r["status"] == "ok")


def test_region_files_take_the_scan_from_the_folder(spark, tmp_path):
    df = spark.createDataFrame([(s, t, s + t / 10) for s in (7, 8) for t in range(3)], "scan int, t int, x0 double")
    files.write_per_scan(df, str(tmp_path / "out"), "scan")
    back = scan_files.read_region_files(spark, str(tmp_path / "out/*/*.csv"), "x0 double", scan="folder")
    assert sorted((int(r["scan"]), r["t"], r["x0"]) for r in back.collect()) == sorted(map(tuple, df.collect()))


def test_archive_members(spark, tmp_path):
    for k in range(5):
        with zipfile.ZipFile(tmp_path / f"a{k}.zip", "w") as z:
            for m in range(k):
                z.writestr(f"folder/m{m}", b"x" * m)
    (tmp_path / "bad.zip").write_bytes(b"PK but no archive")
    found = scan_files.read_archive_members(spark, str(tmp_path / "*.zip"), partition_files=2)
    assert found.rdd.getNumPartitions() == 3
    new = sorted((r["archive"].split("/")[-1], r["member"] or "", r["size"], r["status"]) for r in found.collect())
    old = sorted((r["archive"].split("/")[-1], r["member"] or "", r["size"], r["status"])
                 for r in files.list_archive_members(spark, str(tmp_path / "*.zip")).collect())
    assert new == old and len(new) == 11


def rows_of(spark, puts):
    df = spark.createDataFrame(puts, "k string, v bigint, version bigint, chunk bigint")
    return keyed.make_rows(df, F.col("k"), F.lit("p"), F.lit("D"), F.lit("A"), F.col("v").cast("string"), F.col("version"),
                           chunk=F.col("chunk"))


@pytest.fixture(scope="module")
def versions():
    rng = random.Random(4)
    keys = [f"k{i:03d}" for i in range(120)] + ["k0", "l", "kä", "\U0001f600", "k\U0001f600z"]

    def puts(n, low, high):
        version = rng.sample(range(low, high), n)       # no two alike
        return [(k, v % 97, v, c) for k, v in ((rng.choice(keys), v) for v in version) for c in range(rng.choice([1, 1, 1, 3]))]
    first, later = puts(400, 0, 1000), puts(80, 300, 2000)
    dead = [(rng.choice(keys), rng.randrange(1000)) for _ in range(30)]
    dead_later = [(rng.choice(keys), rng.randrange(300, 2000)) for _ in range(10)]
    return keys, first, later, dead, dead_later


def test_compacted_reads_equal_the_plain_ones(spark, tmp_path, versions):
    keys, first, later, dead, dead_later = versions
    base, graves = rows_of(spark, first), spark.createDataFrame(dead, keyed.TOMBSTONE_SCHEMA)
    compacted.compact(base, graves, str(tmp_path), "g1", ranges=7)
    # later versions win; a put older than a tombstone of the compaction stays hidden
    later = [p for p in later if (p[0], p[2]) not in {(k, v) for k, _, v, _ in first}]
    since, graves_since = rows_of(spark, later), spark.createDataFrame(dead_later, keyed.TOMBSTONE_SCHEMA)

    def seen(df):
        return sorted((r["row_key"], r["chunk"], r["version"], r["data"]["roi"]) for r in df.collect())
    cases = [(compacted.Compacted(spark, str(tmp_path), "g1"), base, graves),
             (compacted.Compacted(spark, str(tmp_path), "g1", since), base.unionByName(since), graves),
             (compacted.Compacted(spark, str(tmp_path), "g1", since, graves_since), base.unionByName(since), graves.unionByName(graves_since)),
             (compacted.Compacted(spark, str(tmp_path), "g1", None, graves_since), base, graves.unionByName(graves_since))]
    for n, (opened, rows, tombstones) in enumerate(cases):
        want = seen(keyed.latest(rows, tombstones))
        assert seen(opened.latest()) == want
        some = [*keys[::9], "none"]
        assert seen(opened.multi_get(some)) == [r for r in want if r[0] in some]
        for k in (keys[5], "kä", "none")[:3 if n == 2 else 1]:
            assert seen(opened.get(k)) == [r for r in want if r[0] == k]
        for p in ("k01", "", "z", "k0", "k\U0001f600", "l")[:6 if n == 2 else 1]:
            assert seen(opened.prefix_scan(p)) == [r for r in want if r[0].startswith(p)]


def test_compacted_plans(spark, tmp_path, versions):
    """No exchange in the read view; look-ups read the folders that hold them."""
    _, first, _, dead, _ = versions
    compacted.compact(rows_of(spark, first), spark.createDataFrame(dead, keyed.TOMBSTONE_SCHEMA), str(tmp_path), "g1", ranges=7)
    t = compacted.Compacted(spark, str(tmp_path), "g1")
    assert "Exchange" not in plan(t.latest()) and "Aggregate" not in plan(t.latest())
    assert t.index.count() == 7 and t.index.agg(F.sum("n")).first()[0] == t.latest().count()

    def folders(df):
        return {r[0].split("range=")[1].split("/")[0] for r in df.select("_metadata.file_path").distinct().collect()}
    assert len(folders(t.rows)) == 7
    one = t._pruned((F.col("first_key") <= "k050") & (F.col("last_key") >= "k050"))
    assert 1 <= len(folders(one)) <= 2
    for df in (t.get("k050"), t.prefix_scan("k05")):
        filters = [line for line in plan(df).splitlines() if "PartitionFilters" in line]
        assert "Exchange" not in plan(df) and filters and all("range#" in f.split("PartitionFilters: ")[1].split("]")[0] for f in filters)
    assert t.get("none").count() == 0
    with pytest.raises(FileNotFoundError):
        compacted.Compacted(spark, str(tmp_path), "g2")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        compacted.compact(rows_of(spark, first), None, str(tmp_path), "g1")
    compacted.compact(rows_of(spark, []), None, str(tmp_path), "empty")
    empty = compacted.Compacted(spark, str(tmp_path), "empty", rows_of(spark, first[:3]))
    assert empty.latest().count() == keyed.latest(rows_of(spark, first[:3])).count() and empty.get("k050").count() <= 1

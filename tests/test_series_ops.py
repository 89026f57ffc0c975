"""Differential tests of the series operators against pandas / NumPy,
including the split (hot-key) code paths and repartition invariance."""

import glob
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import windows
from voxelframe.operators.ordinal import add_ordinal, numeric_split
from voxelframe.operators.split import hash_split, sequential_split


@pytest.fixture(scope="module")
def series_pdf():
    rng = np.random.default_rng(1)
    rows = []
    # scans of lengths 5, 9, 10, 11, 200 and a constant scan; nulls in one
    for scan, n in enumerate([5, 9, 10, 11, 200, 30]):
        for t in range(n):
            v = 7.0 if scan == 5 else float(rng.normal())
            if scan == 4 and t in (50, 51):
                v = None
            rows.append((f"s{scan}", t, v, float(rng.normal())))
    return pd.DataFrame(rows, columns=["scan_id", "t", "x0", "x1"])


def _pandas_rolling(pdf, cols, w=10):
    out = []
    for scan, g in pdf.sort_values("t").groupby("scan_id"):
        r = g[cols].rolling(window=w).mean()
        r["scan_id"] = scan
        r["t"] = g["t"].values
        out.append(r.dropna())
    return pd.concat(out)


@pytest.mark.parametrize("block", [None, 16, 11, 64])
def test_rolling_matches_pandas(spark, series_pdf, block):
    df = spark.createDataFrame(series_pdf).repartition(7)
    got = windows.rolling_mean(df, ["scan_id"], "t", ["x0", "x1"], 10, True, block).toPandas()
    want = _pandas_rolling(series_pdf, ["x0", "x1"])
    got = got.sort_values(["scan_id", "t"]).reset_index(drop=True)
    want = want.sort_values(["scan_id", "t"]).reset_index(drop=True)
    assert len(got) == len(want)
    np.testing.assert_allclose(got[["x0", "x1"]].to_numpy(), want[["x0", "x1"]].to_numpy(), atol=1e-12)
    assert list(got["t"]) == list(want["t"])


def test_ordinal_split_equals_plain(spark):
    rng = np.random.default_rng(2)
    n = 3000
    pdf = pd.DataFrame({"k": rng.integers(0, 3, n), "ts": rng.permutation(n), "id": np.arange(n)})
    df = spark.createDataFrame(pdf).repartition(5)
    plain = add_ordinal(df, ["k"], ["ts", "id"], "t").select("id", "t").toPandas().set_index("id")
    split = add_ordinal(df, ["k"], ["ts", "id"], "t", split_by=numeric_split("ts", 97)) \
        .select("id", "t").toPandas().set_index("id")
    pdf["t"] = pdf.sort_values(["ts", "id"]).groupby("k").cumcount()
    assert (plain.loc[pdf["id"], "t"].values == pdf["t"].values).all()
    assert (split.loc[pdf["id"], "t"].values == pdf["t"].values).all()
    # global position (no key)
    g = add_ordinal(df, [], ["ts", "id"], "pos", split_by=numeric_split("ts", 500)).toPandas()
    assert sorted(g["pos"]) == list(range(n))
    assert (g.sort_values("pos")["ts"].values == np.sort(pdf["ts"].values)).all()


def test_zscore_demean_detrend(spark, series_pdf):
    pdf = series_pdf.dropna()
    df = spark.createDataFrame(pdf)
    z = windows.zscore(df, ["scan_id"], ["x0"]).toPandas().sort_values(["scan_id", "t"])
    d = windows.detrend(df, ["scan_id"], "t", ["x0"]).toPandas().sort_values(["scan_id", "t"])
    m = windows.demean(df, ["scan_id"], ["x0"]).toPandas().sort_values(["scan_id", "t"])
    for scan, g in pdf.sort_values(["scan_id", "t"]).groupby("scan_id"):
        x = g["x0"].to_numpy()
        sd = x.std()
        np.testing.assert_allclose(z[z.scan_id == scan]["x0"], (x - x.mean()) / (sd if sd > 0 else 1.0),
                                   atol=1e-9)
        np.testing.assert_allclose(m[m.scan_id == scan]["x0"], x - x.mean(), atol=1e-12)
        tt = g["t"].to_numpy().astype(float)
        coef = np.polyfit(tt, x, 1)
        np.testing.assert_allclose(d[d.scan_id == scan]["x0"], x - np.polyval(coef, tt), atol=1e-9)


def test_splits(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3).withColumn("t", (F.col("id") / 3).cast("long"))
    s = sequential_split(df, ["k"], "t", 0.7).toPandas()
    for k, g in s.groupby("k"):
        n = len(g)
        assert (g.sort_values("t")["split"].values[: int(0.7 * n)] == "train").all()
        assert (g["split"] == "train").sum() == int(0.7 * n)
    a = hash_split(df, ["id"], 0.3, seed=0).toPandas().set_index("id")["split"]
    b = hash_split(df.repartition(13), ["id"], 0.3, seed=0).toPandas().set_index("id")["split"]
    assert (a.sort_index() == b.sort_index()).all()
    assert 0.2 < (a == "test").mean() < 0.4


def test_sequential_split_after_rolling(spark):
    # positions count from the first kept row, as slicing the smoothed frame does
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") * 1.0).alias("x"))
    r = windows.rolling_mean(df, ["k"], "t", ["x"], 10, True)
    s = sequential_split(r, ["k"], "t", 0.7).toPandas().sort_values("t")
    assert len(s) == 91 and (s["split"] == "train").sum() == int(0.7 * 91)
    assert list(s["split"][: int(0.7 * 91)]) == ["train"] * int(0.7 * 91)


def test_split_by_key_and_minibatches(spark):
    from voxelframe.operators.split import split_by_key
    df = spark.range(3000).select((F.col("id") % 50).alias("person"), F.col("id").alias("t"))
    s = split_by_key(df, "person", 0.3, seed=2).toPandas()
    assert (s.groupby("person")["split"].nunique() == 1).all()      # a person is on one side only
    assert 5 <= s.groupby("person")["split"].first().eq("test").sum() <= 25


@pytest.mark.parametrize("times", ["even", "bursts", "one instant"])
def test_time_ordinal_and_asof(spark, times):
    from voxelframe.operators.asof import asof_join
    from voxelframe.operators.ordinal import add_time_ordinal
    rng = np.random.default_rng(21)
    n = 4000
    at = {"even": rng.integers(0, 10**9, n), "bursts": np.where(rng.random(n) < 0.9, 5, rng.integers(0, 10**9, n)),
          "one instant": np.zeros(n, int)}[times]
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 5, n)),
                        "ts": pd.to_datetime("2024-01-01") + pd.to_timedelta(at, unit="ms"), "id": np.arange(n)})
    df = spark.createDataFrame(pdf).repartition(5)
    numbered = add_time_ordinal(df, ["k"], "ts", ["id"], "t")
    got = numbered.toPandas().set_index("id")
    want = pdf.sort_values(["ts", "id"]).groupby("k").cumcount()
    assert (got.loc[want.index, "t"].values == want.values).all()
    # the written rows are spread evenly, whatever the key sizes and times
    from voxelframe.session import checkpoint_dir
    written = max(glob.glob(os.path.join(checkpoint_dir(spark), "tables", "ordinal_*")), key=os.path.getmtime)
    sizes = spark.read.parquet(written).groupBy(F.input_file_name()).count().toPandas()["count"]
    assert sizes.max() < 2.5 * n / 8
    # the as-of join finds the latest earlier row of the key, over the same ranges
    left, right = df.filter("id % 3 = 0"), df.filter("id % 3 <> 0").select("k", "ts", F.col("id").alias("rid"))
    joined = asof_join(left, right, ["k"], "ts", bucket="auto", right_prefix="r_").toPandas()
    ref = pd.merge_asof(pdf[pdf.id % 3 == 0].sort_values("ts"),
                        pdf[pdf.id % 3 != 0].sort_values("ts").assign(r_ts=lambda d: d.ts)[["k", "ts", "r_ts"]], on="ts", by="k")
    assert joined.set_index("id")["r_ts"].sort_index().equals(ref.set_index("id")["r_ts"].sort_index().astype(joined["r_ts"].dtype))


def test_prefix_sum(spark):
    from voxelframe.operators.ordinal import prefix_sum
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 500), "o": rng.permutation(500), "v": rng.integers(0, 9, 500)})
    got = prefix_sum(spark.createDataFrame(pdf), ["k"], "o", F.col("v"), "s", width=37).toPandas().set_index("o")["s"]
    ordered = pdf.sort_values("o")
    want = (ordered.groupby("k")["v"].cumsum() - ordered["v"]).set_axis(ordered["o"])
    assert (got.loc[want.index] == want).all()

"""As-of join vs pandas.merge_asof; exact quantiles vs NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators.aggregates import exact_quantiles
from voxelframe.operators.asof import asof_cogroup, asof_join


@pytest.fixture(scope="module")
def sides():
    rng = np.random.default_rng(3)
    # one hot key holding most rows
    lk = np.where(rng.random(800) < 0.6, 0, rng.integers(1, 6, 800))
    rk = np.where(rng.random(500) < 0.6, 0, rng.integers(1, 7, 500))
    left = pd.DataFrame({"k": lk, "time": rng.integers(0, 1000, 800), "lv": rng.normal(size=800),
                         "lid": np.arange(800)})
    right = pd.DataFrame({"k": rk, "time": rng.choice(np.arange(1000), 500, replace=False),
                          "rv": rng.normal(size=500)})
    want = pd.merge_asof(left.sort_values("time"), right.sort_values("time"), on="time", by="k")
    return left, right, want.set_index("lid").sort_index()


@pytest.mark.parametrize("width", [None, 1, 37, 250])
def test_asof_join(spark, sides, width):
    left, right, want = sides
    bucket = None if width is None else (lambda c: F.floor(c / width))
    got = asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "time",
                    bucket=bucket).toPandas().set_index("lid").sort_index()
    assert len(got) == len(want)
    np.testing.assert_array_equal(got["rv"].isna().values, want["rv"].isna().values)
    m = ~want["rv"].isna()
    np.testing.assert_allclose(got.loc[m, "rv"].values, want.loc[m, "rv"].values)


@pytest.mark.parametrize("width", [1, 100])
def test_asof_cogroup(spark, sides, width):
    left, right, want = sides
    got = asof_cogroup(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "time",
                       "k long, time long, lv double, lid long, rv double",
                       bucket=lambda c: F.floor(c / width), key_buckets=3).toPandas()
    got = got.set_index("lid").sort_index()
    np.testing.assert_array_equal(got["rv"].isna().values, want["rv"].isna().values)
    m = ~want["rv"].isna()
    np.testing.assert_allclose(got.loc[m, "rv"].values, want.loc[m, "rv"].values)


@pytest.mark.parametrize("bucket", [None, "auto", 3, 50])
def test_asof_ties_and_null_times(spark, bucket):
    """Equal times on the right give the last one by the tie columns, however
    rows are bucketed; null times and keys match nothing on either side."""
    rng = np.random.default_rng(6)

    def some(n, **more):
        t = rng.integers(0, 40, n).astype(object)
        t[rng.random(n) < 0.1] = None
        k = rng.integers(0, 3, n).astype(object)
        k[rng.random(n) < 0.05] = None
        return [tuple(r) for r in zip(k, t, *(v.tolist() for v in more.values()))]
    left = some(150, lid=np.arange(150))
    right = some(300, a=rng.integers(0, 4, 300), rid=np.arange(300))
    want = {}
    for k, t, lid in left:
        fit = [r for r in right if None not in (k, t, r[0], r[1]) and r[0] == k and r[1] <= t]
        want[lid] = max(fit, key=lambda r: (r[1], r[2], r[3]))[3] if fit else None
    ldf = spark.createDataFrame(left, "k long, time long, lid long").repartition(4)
    rdf = spark.createDataFrame(right, "k long, time long, a long, rid long").repartition(3)
    cut = (lambda c: F.floor(c / bucket)) if isinstance(bucket, int) else bucket
    got = asof_join(ldf, rdf, ["k"], "time", bucket=cut, tie_break=["a", "rid"])
    assert {r["lid"]: r["rid"] for r in got.collect()} == want
    merged = asof_cogroup(ldf, rdf, ["k"], "time", "k long, time long, lid long, a long, rid long", bucket=cut,
                          key_buckets=3, tie_break=["a", "rid"])
    rows = merged.collect()
    assert {r["lid"]: r["rid"] for r in rows} == want and len(rows) == 150
    # without tie columns the answer is still the same for every bucketing
    plain = {r["lid"]: r["rid"] for r in asof_join(ldf, rdf, ["k"], "time", bucket=cut).collect()}
    assert plain == {r["lid"]: r["rid"] for r in asof_join(ldf, rdf, ["k"], "time").collect()}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(4)
    n = 20000
    pdf = pd.DataFrame({
        "a": rng.normal(size=n),
        "b": rng.integers(0, 5, n).astype(float),                 # heavy duplicates
        "c": np.where(rng.random(n) < 0.1, np.nan, rng.exponential(size=n)),  # nulls + skew
        "d": np.concatenate([rng.normal(size=n - 3), [1e9, -1e9, 5e8]]),  # outliers
    })
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "a double, b double, c double, d double")
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0]
    for mc in (50, 200_000):
        got = exact_quantiles(df, ["a", "b", "c", "d"], probs, bins=64, max_candidates=mc)
        for c in "abcd":
            want = np.nanpercentile(pdf[c].to_numpy(), [p * 100 for p in probs])
            np.testing.assert_allclose(got[c], want, rtol=0, atol=1e-12)


def test_nan_is_missing(spark):
    from voxelframe.operators.aggregates import describe
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    r = describe(df, ["x"]).first()
    assert r["count"] == 2 and r["mean"] == 2.0 and r["q50"] == 2.0 and r["max"] == 3.0


def test_asof_name_clash(spark):
    l = spark.createDataFrame([(1, 1, 1.0)], "k long, time long, v double")
    r = spark.createDataFrame([(1, 0, 2.0)], "k long, time long, v double")
    with pytest.raises(ValueError):
        asof_join(l, r, ["k"], "time")
    got = asof_join(l, r, ["k"], "time", right_prefix="r_").first()
    assert got["r_v"] == 2.0 and got["r_time"] == 0


def test_asof_auto_buckets(spark, sides):
    """Ranges of eight partitions cut the hot key several times."""
    left, right, want = sides
    got = asof_join(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "time",
                    bucket="auto").toPandas().set_index("lid").sort_index()
    cg = asof_cogroup(spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "time",
                      "k long, time long, lv double, lid long, rv double",
                      bucket="auto").toPandas().set_index("lid").sort_index()
    for g in (got, cg):
        np.testing.assert_array_equal(g["rv"].isna().values, want["rv"].isna().values)
        m = ~want["rv"].isna()
        np.testing.assert_allclose(g.loc[m, "rv"].values, want.loc[m, "rv"].values)

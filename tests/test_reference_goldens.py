"""Golden values of the reference's examples and hand-computed formulas."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voxelframe.operators import formula, udfs
from voxelframe.operators.asof import asof_cogroup, asof_join



# fixed values: inputs and results of the published examples
INTEGERS = [1, 2, 3]
SQUARES, SUCCESSORS = [1, 4, 9], [2, 3, 4]
GROUPED = [(1, 1.0), (1, 2.0), (2, 3.0), (2, 5.0), (2, 10.0)]
MEAN, GROUP_MEANS = 4.2, {1: 1.5, 2: 6.0}
CENTRED = [-3.0, -1.0, -0.5, 0.5, 4.0]
PEOPLE, ADULTS_OF_ONE = [(1, 21), (2, 30)], [(1, 21)]


def _numbers(spark):
    return spark.createDataFrame([(i,) for i in INTEGERS], "x bigint")


def _rows(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(GROUPED)], "rid bigint, id bigint, v double")


COLUMN_CASES = {
    "batches": (lambda: udfs.column_operation(lambda a, b: a * b, "long")("x", "x"), SQUARES),
    "stream of one": (lambda: udfs.stream_operation(lambda s, v: v + s, "long", lambda: 1)("x"), SUCCESSORS),
    "stream of two": (lambda: udfs.stream_operation(lambda _, a, b: a * b, "long")("x", "x"), SQUARES),
}


@pytest.mark.parametrize("case", COLUMN_CASES)
def test_column_operations(spark, case):
    make, want = COLUMN_CASES[case]
    assert [r[0] for r in _numbers(spark).select(make()).collect()] == want


def test_struct_operation(spark):
    df = spark.sql("SELECT 1L AS n, 'a string' AS word, named_struct('col1', 'a nested string') AS s")
    add = udfs.struct_operation({"col2": lambda _, n, word: n + word.str.len()}, "col1 string, col2 long")
    assert df.select(add("s", "n", "word").alias("r")).select("r.*").collect() == [("a nested string", 9)]


AGGREGATES = {
    "one group": (lambda df, m: df.select(m("v").alias("m")), lambda r: None),
    "grouped": (lambda df, m: df.groupBy("id").agg(m("v").alias("m")), lambda r: r["id"]),
    "window": (lambda df, m: df.select("id", m("v").over(Window.partitionBy("id")).alias("m")), lambda r: r["id"]),
    "merged": (lambda df, m: udfs.mean_by(df, ["id"], "v", ["rid"], "m", max_group_rows=1), lambda r: r["id"]),
    "merged, one group": (lambda df, m: udfs.mean_by(df, [], "v", ["rid"], "m", max_group_rows=2), lambda r: None),
}


@pytest.mark.parametrize("case", AGGREGATES)
def test_means(spark, case):
    run, key = AGGREGATES[case]
    for r in run(_rows(spark), udfs.aggregate_operation(lambda v: v.mean(), "double")).collect():
        assert r["m"] == pytest.approx((GROUP_MEANS | {None: MEAN})[key(r)])


@pytest.mark.parametrize("legacy", [False, True])
@pytest.mark.parametrize("max_rows", [1, 100])
def test_map_groups(spark, legacy, max_rows):
    got = udfs.map_groups(_rows(spark), ["id"], ["rid"], lambda d: d.assign(v=d["v"] - d["centre"]),
                          "id long, v double", legacy, max_rows, centre=F.avg("v"))
    assert sorted(r["v"] for r in got.collect()) == pytest.approx(CENTRED)


def test_map_batches(spark):
    df = spark.createDataFrame(PEOPLE, "id bigint, age bigint")
    assert [tuple(r) for r in udfs.map_batches(df, lambda d: d[d["id"] == 1]).collect()] == ADULTS_OF_ONE


def test_asof_reference_example(spark):
    df1 = spark.createDataFrame(
        [(20000101, 1, 1.0), (20000101, 2, 2.0), (20000102, 1, 3.0), (20000102, 2, 4.0)], ("time", "id", "v1"))
    df2 = spark.createDataFrame([(20000101, 1, "x"), (20000101, 2, "y")], ("time", "id", "v2"))
    want = sorted([(20000101, 1, 1.0, "x"), (20000102, 1, 3.0, "x"), (20000101, 2, 2.0, "y"),
                   (20000102, 2, 4.0, "y")])
    a = asof_join(df1, df2, ["id"], "time", bucket=lambda c: c)  # one bucket per day
    assert sorted((r["time"], r["id"], r["v1"], r["v2"]) for r in a.collect()) == want
    b = asof_cogroup(df1, df2, ["id"], "time", "time long, id long, v1 double, v2 string",
                     bucket=lambda c: c)
    assert sorted((r["time"], r["id"], r["v1"], r["v2"]) for r in b.collect()) == want
    # the plain cogroup form of the example
    c = df1.groupby("id").cogroup(df2.groupby("id")).applyInPandas(
        lambda l, r: pd.merge_asof(l, r, on="time", by="id"), schema="time long, id long, v1 double, v2 string")
    assert sorted((r["time"], r["id"], r["v1"], r["v2"]) for r in c.collect()) == want


def test_arrow_roundtrip_and_describe(spark):
    import numpy as np
    from voxelframe.operators.aggregates import describe
    pdf = pd.DataFrame(np.random.default_rng(0).random((100, 3)), columns=["a", "b", "c"])
    df = spark.createDataFrame(pdf)
    back = df.select("*").toPandas()
    pd.testing.assert_frame_equal(back, pdf)
    d = {r["column"]: r for r in describe(df, ["a", "b", "c"]).collect()}
    ref = pdf.describe()
    for c in "abc":
        for stat, key in (("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "q25"),
                          ("50%", "q50"), ("75%", "q75"), ("max", "max")):
            assert d[c][key] == pytest.approx(ref.loc[stat, c], abs=1e-6)
        assert d[c]["count"] == 100


def test_hand_built_trees(spark):
    tree_22 = ("+", ("-", 5, 1), ("*", 3, 2))
    tree = ("*", ("-", ("/", 6, 3), ("-", 4, 2)), tree_22)
    assert formula.constant_value(tree_22) == 10
    assert formula.constant_value(tree) == 0
    t3 = ("/", ("+", -1.39, 0.73), ("/", -1.51, 1.2))
    assert formula.constant_value(t3) == pytest.approx(0.524503, abs=1e-6)
    # the same trees evaluated by Spark (protected division does not trigger here)
    from voxelframe.functions.numeric import register_sql_functions
    register_sql_functions(spark)
    row = spark.range(1).select(*[F.expr(formula.render(t)).alias(f"t{i}")
                                  for i, t in enumerate((tree_22, tree, t3))]).first()
    assert row["t0"] == 10 and row["t1"] == 0 and row["t2"] == pytest.approx(0.524503, abs=1e-6)


def test_worklist_and_labels(spark, tmp_path):
    """Work-list and label files of the shapes the extraction reads: 56
    persons (32 M, 24 F, last line without newline) and work-lists of 8, 4,
    140 (70 ids x 2) and 10 rows."""
    from voxelframe.sources import files
    lab = tmp_path / "labels.csv"
    genders = ["M"] * 32 + ["F"] * 24
    lab.write_text("person,gender\n" + "\n".join(f"{100000 + i},{g}" for i, g in enumerate(genders)))
    df = files.read_labels(spark, str(lab))
    counts = {r["gender"]: r["count"] for r in df.groupBy("gender").count().collect()}
    assert df.count() == 56 and counts == {"M": 32, "F": 24}
    shapes = {"a": (2, 4), "b": (2, 2), "c": (70, 2), "d": (5, 2)}
    for name, (people, per) in shapes.items():
        p = tmp_path / f"{name}.csv"
        rows = [f"/data/{100000 + k}_3T_rfMRI_REST{j + 1}_fixextended.zip,{k + 1}"
                for k in range(people) for j in range(per)]
        p.write_text("path,people_number\n" + "\n".join(rows) + "\n")
        wl = files.read_worklist(spark, str(p))
        assert wl.count() == people * per
        assert wl.select("person").distinct().count() == people

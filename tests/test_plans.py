"""Physical-plan contracts: pruning, pushdown, exchanges, broadcasts."""

import contextlib
import io
import re

import __spark_entry__ as se
from conftest import SF_SMALL

Q = se.queries()


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def count(p, pattern):
    return len(re.findall(pattern, p))


def test_no_cartesian_products(spark):
    for name in ("worklist_cross_anti", "scale_features", "grid_fanout", "cohort_route", "extract_regions",
                 "udf_mean_global", "neighbour_smooth_long"):
        p = plan(Q[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from voxelframe.operators.asof import asof_join
    from voxelframe.plans.q_tables import _asof_sides
    # (with ``bucket="auto"`` the sides are read in the job that writes them)
    p = plan(asof_join(*_asof_sides(spark, SF_SMALL), ["user_id"], "ts", bucket=lambda c: F.to_date(c), right_prefix="click_"))
    assert "EqualTo(event_type,purchase)" in p and "EqualTo(event_type,click)" in p
    # only the needed columns are read (props is never read)
    for m in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        assert "props" not in m
    p = plan(Q["regr_metrics"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert any(s.startswith("l_partkey") and "l_tax" not in s and "l_comment" not in s for s in schemas)


def test_region_means_single_aggregate(spark):
    p = plan(Q["region_mean_pivot"](spark, SF_SMALL))
    assert count(p, r"\(\d+\) Exchange\n") == 1           # one shuffle of partial aggregates
    assert "BroadcastHashJoin" in p                         # atlas broadcast
    assert "PivotFirst" not in p


def test_extraction_reads_voxels_once(spark):
    p = plan(Q["extract_regions"](spark, SF_SMALL))
    assert count(p, r"\(\d+\) Scan parquet") <= 2          # voxels + confounds
    assert count(p, r"\(\d+\) Exchange\n") <= 3


def test_series_statistics_are_broadcast(spark):
    for name in ("zscore_series", "demean_series", "seq_split", "quarantine"):
        p = plan(Q[name](spark, SF_SMALL))
        if name == "quarantine":
            continue
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p, name


def test_rolling_window_is_blocked(spark):
    p = plan(Q["rolling_mean_full"](spark, SF_SMALL))
    assert re.search(r"Arguments: explode\(CASE WHEN \(pmod\(t", p)   # halo rows
    assert re.search(r"Arguments: \[avg\(value", p) is not None
    assert "SinglePartition" not in p


def test_label_lookup_broadcasts_small_side(spark):
    p = plan(Q["cohort_route"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_broadcast_bound(spark):
    from pyspark.sql import functions as F
    from voxelframe.operators.joins import max_broadcast_rows, sized_broadcast
    small = spark.range(10).withColumn("s", F.lit("x"))
    assert max_broadcast_rows(small) > 100_000
    big = spark.range(50)
    left = spark.range(1000)
    p_small = plan(left.join(sized_broadcast(big, max_rows=100), "id"))
    assert "BroadcastHashJoin" in p_small
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p_big = plan(left.join(sized_broadcast(big, max_rows=10), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in p_big

"""Pandas-UDF surface queries (each has a native SQL twin)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelframe.functions.numeric import r6, sql_r6
from voxelframe.operators import udfs
from voxelframe.operators.asof import asof_cogroup
from voxelframe.plans.q_tables import _ASOF_SQL, _asof_sides
from voxelframe.plans.registry import query
from voxelframe.tables import table


def _product(a, b):
    return a * b


@query("udf_multiply", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) * l_suppkey AS m FROM lineitem")
def udf_multiply(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     udfs.column_operation(_product, "long")(
                         F.col("l_linenumber").cast("long"), F.col("l_suppkey")).alias("m"))


@query("udf_plus_one", "SELECT l_orderkey, l_linenumber, l_partkey + 1 AS p FROM lineitem")
def udf_plus_one(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # the increment stands for state that is built once per partition
    add = udfs.stream_operation(lambda state, v: v + state["step"], "long", lambda: {"step": 1})
    return li.select("l_orderkey", "l_linenumber", add("l_partkey").alias("p"))


@query("udf_multiply_two_cols", "SELECT l_orderkey, l_linenumber, l_partkey * l_suppkey AS m FROM lineitem")
def udf_multiply_two_cols(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    times = udfs.stream_operation(lambda _, a, b: _product(a, b), "long")
    return li.select("l_orderkey", "l_linenumber", times("l_partkey", "l_suppkey").alias("m"))


@query("udf_struct", "SELECT event_id, props AS col1, event_id + length(event_type) AS col2 FROM events")
def udf_struct(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    extend = udfs.struct_operation({"col2": lambda _, number, word: number + word.str.len()}, "col1 string, col2 long")
    s = ev.select("event_id", extend(F.struct(F.col("props").alias("col1")), F.col("event_id"),
                                     F.col("event_type")).alias("r"))
    return s.select("event_id", "r.col1", "r.col2")


@query("udf_mean_global", f"SELECT {sql_r6('avg(value)', 8)} AS mean_v FROM events")
def udf_mean_global(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    m = udfs.mean_by(ev, [], "value", ["event_id"])
    return m.select(r6(F.col("mean_v"), 8).alias("mean_v"))


@query("udf_mean_agg", f"SELECT user_id, {sql_r6('avg(value)', 8)} AS mean_v FROM events GROUP BY user_id")
def udf_mean_agg(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    m = udfs.mean_by(ev, ["user_id"], "value", ["event_id"])
    return m.select("user_id", r6(F.col("mean_v"), 8).alias("mean_v"))


@query("udf_mean_window", f"""
SELECT event_id, user_id, value, {sql_r6('avg(value) OVER (PARTITION BY user_id)', 8)} AS mean_v FROM events""")
def udf_mean_window(spark, sf_dir):
    """The group mean as a column on every row (an unbounded window)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    m = udfs.mean_by(ev, ["user_id"], "value", ["event_id"])
    from voxelframe.operators.joins import broadcast_if_small
    return ev.join(broadcast_if_small(m), "user_id").select("event_id", "user_id", "value",
                                        r6(F.col("mean_v"), 8).alias("mean_v"))


_DEMEAN_SQL = f"SELECT event_id, user_id, {sql_r6('value - avg(value) OVER (PARTITION BY user_id)', 8)} AS v FROM events"


def _demean(spark, sf_dir, legacy):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("value").alias("v"))
    out = udfs.map_groups(ev, ["user_id"], ["event_id"], lambda d: d.assign(v=d["v"] - d["centre"]),
                          "event_id long, user_id long, v double", legacy, centre=F.avg("v"))
    return out.select("event_id", "user_id", r6(F.col("v"), 8).alias("v"))


@query("udf_grouped_map", _DEMEAN_SQL)
def udf_grouped_map(spark, sf_dir):
    return _demean(spark, sf_dir, legacy=False)


@query("udf_grouped_map_legacy", _DEMEAN_SQL)
def udf_grouped_map_legacy(spark, sf_dir):
    return _demean(spark, sf_dir, legacy=True)


@query("udf_map_filter", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 1")
def udf_map_filter(spark, sf_dir):
    return udfs.map_batches(table(spark, sf_dir, "customer"), lambda d: d[d["c_nationkey"] == 1])


@query("udf_cogroup_asof", _ASOF_SQL)
def udf_cogroup_asof(spark, sf_dir):
    """As-of join through cogrouped ``applyInPandas`` + ``merge_asof`` on even
    ranges of (user, time) with the carried-in click."""
    left, right = _asof_sides(spark, sf_dir)
    right = right.select("user_id", "ts", F.col("event_id").alias("click_event_id"),
                         F.col("value").alias("click_value"), F.col("ts").alias("click_ts"))
    schema = ("event_id long, user_id long, ts timestamp_ntz, value double, "
              "click_event_id long, click_value double, click_ts timestamp_ntz")
    return asof_cogroup(left, right, ["user_id"], "ts", schema, bucket="auto")

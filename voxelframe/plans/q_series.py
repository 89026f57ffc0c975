"""Series queries: ordinal, rolling mean, z-score, de-mean, detrend, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxelframe.functions.numeric import r6, sql_r6
from voxelframe.operators import windows
from voxelframe.operators.joins import label_lookup, route
from voxelframe.operators.split import sequential_split
from voxelframe.plans.registry import query
from voxelframe.plans.stand_ins import MEN_SEGMENT, SERIES_SQL, series
from voxelframe.tables import table

# Rows per block of the rolling window: each block is one task at most,
# and carries 9 halo rows from the block before it.
ROLL_BLOCK = 65536

_ROLL_SQL = f"""
WITH o AS ({SERIES_SQL}),
w AS (SELECT user_id, t, event_type,
        avg(value) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m,
        count(value) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n
      FROM o)
"""


def rolled(spark, sf_dir):
    s = series(spark, sf_dir)
    return windows.rolling_mean(s, ["user_id"], "t", ["value"], window=10,
                                full_only=True, block=ROLL_BLOCK)


@query("rolling_mean_full", _ROLL_SQL + f"SELECT user_id, t, {sql_r6('m')} AS value_rm FROM w WHERE n = 10")
def rolling_mean_full(spark, sf_dir):
    return rolled(spark, sf_dir).select("user_id", "t", r6(F.col("value")).alias("value_rm"))


def cohort_rolling_mean(spark, sf_dir):
    """Flagship: rolling mean -> person label -> cohort -> mean per cohort and label."""
    r = rolled(spark, sf_dir)
    labels = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment"))
    j = label_lookup(r, labels, "user_id")
    return (j.withColumn("cohort", route(F.col("c_mktsegment"), MEN_SEGMENT, "men", "women"))
             .groupBy("cohort", "event_type")
             .agg(r6(F.avg("value")).alias("mean_rm"), F.count(F.lit(1)).alias("n")))


query("cohort_rolling_mean", _ROLL_SQL + f"""
SELECT CASE WHEN c.c_mktsegment = '{MEN_SEGMENT}' THEN 'men' ELSE 'women' END AS cohort,
       w.event_type, {sql_r6('avg(w.m)')} AS mean_rm, count(*) AS n
FROM w JOIN customer c ON c.c_custkey = w.user_id
WHERE w.n = 10 GROUP BY 1, 2""")(cohort_rolling_mean)


@query("zscore_series", f"""
SELECT event_id, user_id,
  {sql_r6("(value - avg(value) OVER (PARTITION BY user_id)) / CASE WHEN coalesce(stddev_pop(value) OVER (PARTITION BY user_id), 0) = 0 THEN 1.0 ELSE stddev_pop(value) OVER (PARTITION BY user_id) END")} AS z
FROM events""")
def zscore_series(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return windows.zscore(ev, ["user_id"], ["value"]).select(
        "event_id", "user_id", r6(F.col("value")).alias("z"))


@query("demean_series", f"""
SELECT event_id, user_id, {sql_r6("value - avg(value) OVER (PARTITION BY user_id)", 8)} AS v
FROM events""")
def demean_series(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    # 8 digits: a mean of 2-decimal values over 2^k rows can end in an exact
    # tie at 6 digits, where engines legitimately round differently
    return windows.demean(ev, ["user_id"], ["value"]).select(
        "event_id", "user_id", r6(F.col("value"), 8).alias("v"))


@query("detrend_series", f"""
WITH o AS ({SERIES_SQL})
SELECT event_id, user_id, t,
  {sql_r6("value - (avg(value) OVER (PARTITION BY user_id) + coalesce(regr_slope(value, t) OVER (PARTITION BY user_id), 0) * (t - avg(t) OVER (PARTITION BY user_id)))")} AS v
FROM o""")
def detrend_series(spark, sf_dir):
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    return windows.detrend(s, ["user_id"], "t", ["value"]).select(
        "event_id", "user_id", "t", r6(F.col("value")).alias("v"))


@query("zscore_by_session", f"""
SELECT event_id, user_id, event_type,
  {sql_r6("(value - avg(value) OVER (PARTITION BY user_id, event_type)) / CASE WHEN coalesce(stddev_pop(value) OVER (PARTITION BY user_id, event_type), 0) = 0 THEN 1.0 ELSE stddev_pop(value) OVER (PARTITION BY user_id, event_type) END")} AS z
FROM events""")
def zscore_by_session(spark, sf_dir):
    """Per-session cleaning: the session is part of the series key
    (here the event type plays the session)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return windows.zscore(ev, ["user_id", "event_type"], ["value"]).select(
        "event_id", "user_id", "event_type", r6(F.col("value")).alias("z"))


@query("seq_split", f"""
WITH o AS ({SERIES_SQL}), c AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM o)
SELECT user_id, t, CASE WHEN t < floor(CAST(0.7 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM c""")
def seq_split(spark, sf_dir):
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id"))
    # series lengths straight from the source rows (no need for t)
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    return sequential_split(s, ["user_id"], "t", 0.7, counts=n).select("user_id", "t", "split")


@query("time_mask", f"""
WITH o AS ({SERIES_SQL})
SELECT user_id, t, value FROM o WHERE t >= 5 AND t NOT IN (SELECT DISTINCT t FROM o WHERE event_type = 'error' AND value > 45)""")
def time_mask(spark, sf_dir):
    """Keep a subset of time points given by a mask table: drop the first
    five volumes and every time index that carries a large error event."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "event_type", "value"))
    from voxelframe.operators.joins import broadcast_if_small
    # the mask has at most one row per time index (bounded by the longest
    # series): computed once, broadcast when proven small, so the series
    # rows are not shuffled by t
    bad = broadcast_if_small(
        s.filter((F.col("event_type") == "error") & (F.col("value") > 45)).select("t").distinct())
    return (s.filter(F.col("t") >= 5).join(bad, "t", "left_anti")
             .select("user_id", "t", "value"))

"""How the hot-key code paths spread a key that holds a third of all rows.

Derives a skewed copy of the events table (rows replicated x20 with new ids
and shifted dates; every third event is given to one user), runs each
operator with and without its split, and reports the largest share of the
operator's output rows produced by one task (rows per spark_partition_id
right after the operator, AQE coalescing off).  16 tasks -> 6% is an even
spread; ~33% means the hot key sat in one task.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from voxelframe.operators import udfs, windows  # noqa: E402
from voxelframe.operators.asof import asof_join  # noqa: E402
from voxelframe.operators.ordinal import add_ordinal, add_time_ordinal, day_split, prefix_sum  # noqa: E402
from voxelframe.session import build_session  # noqa: E402
from voxelframe.sources.files import read_region_csvs  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    extra = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for kv in [a for a in sys.argv[2:] if "=" in a]:
        k, v = kv.split("=", 1)
        extra[k] = v
    spark = build_session("local[8]", 16, extra=extra)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    rep = 20
    n_src = ev.count()
    base = (ev.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rep - 1))))
              .withColumn("event_id", F.col("event_id") + F.col("r") * F.lit(n_src))
              .withColumn("ts", F.col("ts") + F.make_interval(days=F.col("r") * F.lit(31)))
              .withColumn("user_id", F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit(0))
                                       .otherwise(F.col("user_id")))
              .drop("r"))
    total = base.count()
    print(f"rows {total:,}; hot key holds {base.filter(F.col('user_id') == 0).count():,}")

    def report(name, df):
        t0 = time.perf_counter()
        # consume every output column so no operator is pruned away
        per = (df.withColumn("_h", F.xxhash64(*[F.col(c) for c in df.columns]))
                 .groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("count"), F.max("_h").alias("_s")).collect())
        sec = time.perf_counter() - t0
        counts = [r["count"] for r in per]
        print(f"{name:36s} {sec:6.2f}s  tasks={len(counts):3d}  busiest task {max(counts):9,} rows "
              f"({max(counts) / sum(counts):.0%})")

    plain = add_ordinal(base, ["user_id"], ["ts", "event_id"], "t")
    split = add_ordinal(base, ["user_id"], ["ts", "event_id"], "t", split_by=day_split("ts"))
    adaptive = add_time_ordinal(base, ["user_id"], "ts", ["event_id"], "t")
    report("ordinal, one window per key", plain)
    report("ordinal, split by day", split)
    report("ordinal, sampled ranges", adaptive)
    s = split.select("user_id", "t", "value").persist()
    s.count()
    report("rolling mean, one window per key", windows.rolling_mean(s, ["user_id"], "t", ["value"], 10, True, None))
    report("rolling mean, 4096-row blocks + halo", windows.rolling_mean(s, ["user_id"], "t", ["value"], 10, True, 4096))
    left = base.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    right = base.filter(F.col("event_type") == "click").select("user_id", "ts", F.col("value").alias("cv"))
    report("as-of join, one bucket per key", asof_join(left, right, ["user_id"], "ts"))
    report("as-of join, day buckets", asof_join(left, right, ["user_id"], "ts", bucket=lambda c: F.to_date(c)))
    report("as-of join, sampled ranges", asof_join(left, right, ["user_id"], "ts", bucket="auto"))
    # nine in ten events of every user at one instant
    burst = base.withColumn("ts", F.when(F.col("event_id") % 10 != 0, F.lit("2024-01-01").cast("timestamp_ntz")).otherwise(F.col("ts")))
    report("bursts: ordinal, split by day", add_ordinal(burst, ["user_id"], ["ts", "event_id"], "t", split_by=day_split("ts")))
    report("bursts: ordinal, sampled ranges", add_time_ordinal(burst, ["user_id"], "ts", ["event_id"], "t"))
    left = burst.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    right = burst.filter(F.col("event_type") == "click").select("user_id", "ts", F.col("value").alias("cv"))
    report("bursts: as-of join, sampled ranges", asof_join(left, right, ["user_id"], "ts", bucket="auto"))
    counted = base.select("user_id", "event_id", F.length("event_type").alias("v"))
    report("prefix sums per (key, id range)", prefix_sum(counted, ["user_id"], "event_id", F.col("v"), "before"))
    one = tempfile.mkdtemp(prefix="skew-")
    base.select("value", "user_id").coalesce(1).write.mode("overwrite").option("header", True).csv(one)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    report("one large CSV file", read_region_csvs(spark, one, "value double, user_id bigint"))
    g = base.select("event_id", "user_id", F.col("value").alias("v"))
    schema = "event_id long, user_id long, v double"
    for name, rows in (("no split", 10 ** 12), ("50k-row pieces", 50_000)):
        report(f"grouped map, {name}", udfs.map_groups(
            g, ["user_id"], ["event_id"], lambda d: d.assign(v=d["v"] - d["centre"]), schema, max_group_rows=rows,
            centre=F.avg("v")))
    spark.stop()


if __name__ == "__main__":
    main()

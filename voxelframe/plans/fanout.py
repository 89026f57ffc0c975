"""Parameter-grid fan-out: one run per job, each with its parameter set and
its own slice of the data, all in one Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.tables import table


def parameter_sets(part: DataFrame) -> DataFrame:
    """(job_id, params map) -- 1-based job ids."""
    return part.select((F.col("p_partkey") + 1).alias("job_id"),
                       F.create_map(F.lit("size"), F.col("p_size").cast("string"),
                                    F.lit("brand"), F.col("p_brand")).alias("params"))


def grid_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    n = part.count()
    jobs = spark.range(1, n + 1).withColumnRenamed("id", "job_id")
    params = parameter_sets(part)
    li = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + 1).alias("job_id"), "l_orderkey", "l_quantity")
    runs = jobs.join(params, "job_id")
    work = li.groupBy("job_id").agg(F.count("l_orderkey").alias("n_lines"), F.sum("l_quantity").alias("qty"))
    return runs.join(work, "job_id", "left").select(
        "job_id", F.col("params")["size"].alias("size"), F.col("params")["brand"].alias("brand"),
        F.coalesce(F.col("n_lines"), F.lit(0)).alias("n_lines"), F.col("qty"))

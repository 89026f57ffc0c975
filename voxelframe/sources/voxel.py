"""Voxel and atlas tables (decoded images are an input contract:
``(scan_id, voxel_id, t, value)`` Parquet, partitioned by scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOXEL_SCHEMA = "scan_id string, voxel_id bigint, t int, value double"
ATLAS_SCHEMA = "atlas string, voxel_id bigint, label int"
CONFOUND_SCHEMA = "scan_id string, t int, c0 double, c1 double, c2 double, c3 double, c4 double"


def read_voxels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOXEL_SCHEMA).parquet(path)


def read_atlas(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The label table of one atlas; an unknown atlas is an error raised
    before any job runs on the voxels."""
    a = spark.read.schema(ATLAS_SCHEMA).parquet(path).filter(F.col("atlas") == name)
    if a.limit(1).count() == 0:
        raise OSError(f"there is no atlas {name}")
    return a

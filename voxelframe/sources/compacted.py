"""Compacted layout of a keyed table.

A compaction reads versions and tombstones once and writes what a reader would
see, one version per key, range-partitioned and sorted by key: a folder per
range, and an index with every range's first and last key.  So

* a full read is a scan, without an exchange;
* a point get, a multi-get of listed keys and a prefix scan look their ranges
  up in the index and read those folders alone;
* rows and tombstones written since are laid over the scan: only keys that they
  touch are resolved by version, all others pass through.

A compaction is a generation of its own, named by ``gen``; readers keep the one
they opened.  Versions of hidden keys are kept as tombstones, so a late put of
an older version stays hidden.
"""

from __future__ import annotations

import os
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.operators.joins import broadcast_if_small, sized_broadcast
from voxelframe.sources import keyed

ROWS, INDEX, DEAD = "rows", "index", "tombstones"
INDEX_SCHEMA = "range int, first_key string, last_key string, n bigint"
# ranges that a listed look-up may name in its plan; more go by a join
MAX_RANGES = 1000


def compact(rows: DataFrame, tombstones: DataFrame | None, out: str, gen: str, ranges: int | None = None) -> None:
    """Write the read view of ``rows`` and ``tombstones`` as generation ``gen``
    below ``out``.  ``ranges`` defaults to the shuffle partitions, which are
    sized to the data; an existing generation is not written over."""
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = os.path.join(out, gen)
    view = keyed.latest(rows, tombstones)
    cut = view.repartitionByRange(ranges, "row_key", "chunk").withColumn("range", F.spark_partition_id())
    cut.sortWithinPartitions("row_key", "chunk").write.partitionBy("range").parquet(os.path.join(path, ROWS))
    written = _rows(spark, path)
    (written.groupBy("range").agg(F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"),
                                  F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(os.path.join(path, INDEX)))
    dead = spark.createDataFrame([], keyed.TOMBSTONE_SCHEMA) if tombstones is None else (
        tombstones.groupBy("row_key").agg(F.max("version").alias("version")))
    dead.select("row_key", "version").write.parquet(os.path.join(path, DEAD))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    rows = os.path.join(path, ROWS)
    from voxelframe.sources.files import path_exists
    if not path_exists(spark, rows):
        raise FileNotFoundError(f"no compaction at {path}")
    return spark.read.schema(keyed.KEYED_SCHEMA + ", range int").parquet(rows)


class Compacted:
    """A compaction opened for reading, with rows and tombstones written since."""

    def __init__(self, spark: SparkSession, out: str, gen: str, since: DataFrame | None = None,
                 dead_since: DataFrame | None = None):
        path = os.path.join(out, gen)
        self.spark, self.rows = spark, _rows(spark, path)
        self.index = spark.read.schema(INDEX_SCHEMA).parquet(os.path.join(path, INDEX))
        self.dead = spark.read.schema(keyed.TOMBSTONE_SCHEMA).parquet(os.path.join(path, DEAD))
        self.since, self.dead_since = since, dead_since

    def _over(self, base: DataFrame, keep) -> DataFrame:
        """``base`` with what was written since for the keys that ``keep`` (a
        function on frames with row_key) leaves."""
        columns = [c for c in base.columns if c != "range"]
        base = base.select(*columns)
        if self.since is None and self.dead_since is None:
            return base
        since = keep(self.since) if self.since is not None else base.limit(0)
        buried = keep(self.dead if self.dead_since is None else self.dead.unionByName(self.dead_since))
        touched = since.select("row_key")
        if self.dead_since is not None:
            touched = touched.unionAll(keep(self.dead_since).select("row_key"))
        touched = broadcast_if_small(touched.distinct())
        changed = base.join(touched, "row_key", "left_semi").unionByName(since.select(*columns))
        return base.join(touched, "row_key", "left_anti").unionByName(keyed.latest(changed, buried).select(*columns))

    def latest(self) -> DataFrame:
        """The read view of everything."""
        return self._over(self.rows, lambda df: df)

    def _pruned(self, wanted) -> DataFrame:
        """Rows of the ranges for which ``wanted`` (a condition on the index) holds."""
        ids = [r["range"] for r in self.index.filter(wanted).select("range").limit(MAX_RANGES + 1).collect()]
        if len(ids) > MAX_RANGES:
            return self.rows.join(sized_broadcast(self.index.filter(wanted).select("range")), "range", "left_semi")
        return self.rows.filter(F.col("range").isin(ids)) if ids else self.rows.limit(0)

    def get(self, key: str) -> DataFrame:
        """The rows of one key."""
        return self.multi_get([key])

    def multi_get(self, keys: Iterable[str]) -> DataFrame:
        """The rows of listed keys."""
        keys = list(keys)
        wanted = F.lit(False)
        for k in keys:
            wanted = wanted | ((F.col("first_key") <= k) & (F.col("last_key") >= k))
        return self._over(self._pruned(wanted).filter(F.col("row_key").isin(keys)), lambda df: df.filter(F.col("row_key").isin(keys)))

    def prefix_scan(self, prefix: str) -> DataFrame:
        """The rows of all keys that start with ``prefix``."""
        # a range holds one if it ends at the prefix or later and does not begin beyond its keys
        wanted = (F.col("last_key") >= prefix) & ((F.col("first_key") <= prefix) | F.col("first_key").startswith(prefix))
        return self._over(self._pruned(wanted).filter(F.col("row_key").startswith(prefix)),
                          lambda df: df.filter(F.col("row_key").startswith(prefix)))

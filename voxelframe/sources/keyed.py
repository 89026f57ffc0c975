"""Keyed latest-version table (the wide-column store of the reference,
re-expressed as an append-only Parquet table plus a read view).

Writes append ``(row_key, data, metadata, version)`` rows; a put is
idempotent because the read view keeps, per key, the row with the largest
version (a retried append writes an identical row).  A value too long
for one cell is put as several rows of the same key and version that
differ in ``chunk``.  Deletes append
tombstones ``(row_key, version)``: a key is hidden when its newest put is
not newer than its newest tombstone.

Reads: full scan (optionally filtered on dataset/atlas), point get,
multi-get, prefix scan.  Filters on ``row_key`` and on the top-level
``dataset``/``atlas`` columns reach the Parquet scan.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.operators.joins import sized_broadcast

KEYED_SCHEMA = ("row_key string, dataset string, atlas string, "
                "data struct<person:string,dataset:string,atlas:string,roi:string>, "
                "metadata map<string,string>, version bigint, chunk bigint")
TOMBSTONE_SCHEMA = "row_key string, version bigint"


def create_table(spark: SparkSession, path: str) -> None:
    """Create an empty keyed table (families ``data`` and ``metadata``)."""
    spark.createDataFrame([], KEYED_SCHEMA).write.mode("ignore").parquet(path)


def make_rows(df: DataFrame, row_key: Column, person: Column, dataset: Column, atlas: Column,
              roi: Column, version: Column, metadata: Column | None = None,
              chunk: Column | None = None) -> DataFrame:
    """Shape any frame into keyed-table rows."""
    md = metadata if metadata is not None else F.create_map().cast("map<string,string>")
    return df.select(
        row_key.cast("string").alias("row_key"),
        dataset.cast("string").alias("dataset"),
        atlas.cast("string").alias("atlas"),
        F.struct(person.cast("string").alias("person"), dataset.cast("string").alias("dataset"),
                 atlas.cast("string").alias("atlas"), roi.cast("string").alias("roi")).alias("data"),
        md.alias("metadata"),
        version.cast("bigint").alias("version"),
        (F.lit(0) if chunk is None else chunk).cast("bigint").alias("chunk"))


def put(rows: DataFrame, path: str) -> None:
    """Append rows (one put per row)."""
    rows.write.mode("append").partitionBy("dataset", "atlas").parquet(path)


def delete(spark: SparkSession, keys: DataFrame, version: Column, path: str) -> None:
    """Append tombstones for ``keys.row_key`` at ``version``."""
    keys.select(F.col("row_key"), version.cast("bigint").alias("version")) \
        .write.mode("append").parquet(path)


def scan(spark: SparkSession, path: str, dataset: str | None = None,
         atlas: str | None = None) -> DataFrame:
    """Raw rows, with partition pruning on dataset and atlas."""
    df = spark.read.schema(KEYED_SCHEMA).parquet(path)
    if dataset is not None:
        df = df.filter(F.col("dataset") == dataset)
    if atlas is not None:
        df = df.filter(F.col("atlas") == atlas)
    return df


def latest(rows: DataFrame, tombstones: DataFrame | None = None) -> DataFrame:
    """Read view: newest version per key, minus deleted keys.

    ``max_by`` is a partial aggregate, so a key with very many versions is
    combined map-side rather than gathered into one task.
    """
    payload = [c for c in rows.columns if c not in ("row_key", "version", "chunk")]
    newest = rows.groupBy("row_key", F.coalesce("chunk", F.lit(0)).alias("chunk")).agg(
        F.max_by(F.struct(*payload), F.col("version")).alias("_p"),
        F.max("version").alias("version"))
    # a newer put may have fewer chunks: those of older versions are gone
    last = newest.groupBy("row_key").agg(F.max("version").alias("_v"))
    view = (newest.join(last, "row_key").filter(F.col("version") == F.col("_v"))
                  .select("row_key", "_p.*", "version", "chunk"))
    if tombstones is None:
        return view
    dead = tombstones.groupBy("row_key").agg(F.max("version").alias("_dv"))
    return (view.join(dead, "row_key", "left")
                .filter(F.col("_dv").isNull() | (F.col("version") > F.col("_dv")))
                .drop("_dv"))


def get(view: DataFrame, key: str) -> DataFrame:
    return view.filter(F.col("row_key") == F.lit(key))


def multi_get(view: DataFrame, keys: Iterable[str] | DataFrame) -> DataFrame:
    """Rows for a list of keys: ``isin`` for a literal list, a semi join
    (broadcast when the key list is proven small) for a key table."""
    if isinstance(keys, DataFrame):
        return view.join(sized_broadcast(keys.select("row_key").distinct()), "row_key", "left_semi")
    return view.filter(F.col("row_key").isin(list(keys)))


def prefix_scan(view: DataFrame, prefix: str) -> DataFrame:
    return view.filter(F.col("row_key").startswith(prefix))


def flatten(view: DataFrame, cols: Sequence[str] = ("person", "dataset", "atlas", "roi")) -> DataFrame:
    return view.select("row_key", *[F.col(f"data.{c}").alias(c) for c in cols], "version")

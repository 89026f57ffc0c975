"""Session construction and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on.  AQE re-plans joins at run
# time from measured shuffle sizes (broadcast conversion, skew splitting,
# partition coalescing); UTC keeps timestamp_ntz arithmetic deterministic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the reference trains on 8096-row slices; keep Arrow batches that size
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8096",
    # jobs started from several threads (fits side by side) share the cores
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the DataFrame that owns them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(total_cores: int, input_bytes: int, partition_bytes: int = 256 << 20,
                 broadcast_bytes: int = 64 << 20) -> dict:
    """Settings sized for a cluster run (pass as ``extra`` to build_session
    or to spark-submit).

    Scan splits and shuffle partitions of ~``partition_bytes`` keep every
    task's working set well inside executor memory (window and aggregate
    operators spill beyond that); AQE coalesces small shuffle partitions
    and splits skewed ones larger than the same size.  E.g. 100 TB on
    8,000 cores -> 409,600 shuffle partitions before coalescing.
    """
    import math
    parts = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "voxelframe", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers.

    Functions used in pandas UDFs live in package modules; the workers
    import them by name.  The package is zipped once per application and
    added with ``addPyFile`` (the runtime form of ``--py-files``), which
    distributes it to every executor.  Skipped when the workers can already
    import it (installed package or ``--py-files`` given at submit time is
    detected by the caller's environment) -- a second add is harmless.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    # the zip goes to the shared checkpoint folder when it is a mounted
    # path; for remote stores the driver's own temp folder serves
    # (addPyFile copies it to the executors either way)
    shared = checkpoint_dir(spark)
    shared = shared[len("file:"):] if shared.startswith("file:") else shared
    where = os.path.join(shared, "pyfiles") if "://" not in shared else None
    if where:
        os.makedirs(where, exist_ok=True)
    fd, path = tempfile.mkstemp(prefix="voxelframe-", suffix=".zip", dir=where)
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local run without a setting
    gets a private scratch folder; on a cluster, where executors could not
    see it, a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="voxelframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame) -> DataFrame:
    """Compute a derived table once: written as Parquet below the shared
    checkpoint folder and read back, so lineage ends there, later readers
    take the columns they need, and a lost executor costs a re-read."""
    import uuid
    path = table_path(df.sparkSession, f"derived_{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written stage table;
    it is removed when the driver's JVM ends."""
    path = os.path.join(checkpoint_dir(spark), "tables", name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def mounted_folder(spark: SparkSession, path: str) -> str | None:
    """The path as tasks can open it, None on a remote store."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(where).toUri().getPath() if store.getUri().getScheme() == "file" else None

"""Region extraction: voxel rows -> region time series, cleaned.

voxels (scan, voxel, t, value) -> broadcast atlas join -> mean per region
and time point (partial aggregate + fixed-list pivot) -> confound
regression per scan -> detrend / z-score per scan (and session).
Keyed by scan, so the work spreads over scans rather than persons; every
per-scan statistic is a grouped aggregate joined back.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators import linear, windows
from voxelframe.operators.aggregates import region_means
from voxelframe.operators.joins import align_on_time, time_gaps


def extract_regions(voxels: DataFrame, atlas: DataFrame, labels: Sequence, keys: Sequence[str] = ("scan_id",),
                    t: str = "t", confounds: DataFrame | None = None, confound_cols: Sequence[str] = (),
                    standardize: bool = True, detrend: bool = False,
                    session_keys: Sequence[str] = (), min_std: float = 1e-9,
                    how: str = "window") -> DataFrame:
    """``how="window"``: after the voxel aggregation a series has one row per
    time point, so per-scan statistics are window aggregates on one
    scan-partitioned exchange shared by every cleaning step."""
    keys = list(keys)
    names = [f"x{i}" for i in range(len(labels))]
    wide = region_means(voxels, atlas, [*keys, *session_keys, t], "label", "value", labels, names)
    series_keys = [*keys, *session_keys]
    if confounds is not None and confound_cols:
        wide = align_on_time(wide, confounds, [*keys, t])
        if len(confound_cols) == 1:
            wide = linear.single_confound_residual(wide, series_keys, names, confound_cols[0], how=how)
        else:
            wide = linear.confound_residuals(wide, series_keys, names, list(confound_cols))
        wide = wide.drop(*confound_cols)
    if detrend:
        wide = windows.detrend(wide, series_keys, t, names, how=how)
    if standardize:
        wide = windows.zscore(wide, series_keys, names, min_std=min_std, how=how)
    return wide


def quarantine(stats: DataFrame, checks: dict) -> tuple[DataFrame, DataFrame]:
    """Split per-scan results into (good, quarantined) by named checks
    ``{error text: failing condition}``; the first failing check is the
    scan's error.  Replaces try/except-and-continue inside a UDF."""
    err = F.lit(None).cast("string")
    for text, failing in reversed(list(checks.items())):
        err = F.when(failing, F.lit(text)).otherwise(err)
    s = stats.withColumn("error", err).withColumn(
        "status", F.when(F.col("error").isNull(), F.lit("ok")).otherwise(F.lit("error")))
    return s.filter(F.col("status") == "ok"), s.filter(F.col("status") == "error")


def scan_status(work: DataFrame, regions: DataFrame, confounds: DataFrame | None = None,
                key: str = "scan_id", t: str = "t", outcome: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): one row for every scan of the work list, with
    n_timepoints, n_gaps (time points without a confound row), status and
    error.  A scan without voxel rows or with gaps is quarantined, and one
    whose row in ``outcome`` (key, error; see ``operators.guarded``) names an
    error."""
    points = regions.groupBy(key).agg(F.count(F.lit(1)).alias("n_timepoints"))
    stats = work.join(points, key, "left").withColumn("n_timepoints", F.coalesce("n_timepoints", F.lit(0)))
    if confounds is None:
        stats = stats.withColumn("n_gaps", F.lit(0).cast("bigint"))
    else:
        gaps = time_gaps(regions, confounds, [key, t]).withColumnRenamed("missing", "n_gaps")
        stats = stats.join(gaps, key, "left").withColumn("n_gaps", F.coalesce("n_gaps", F.lit(0)))
    checks = {"no voxel rows": F.col("n_timepoints") == 0, "time points without confounds": F.col("n_gaps") > 0}
    if outcome is None:
        return quarantine(stats, checks)
    stats = stats.join(outcome.select(key, F.col("error").alias("_raised")), key, "left")
    good, bad = quarantine(stats, checks)
    raised = good.filter("_raised is not null").withColumns({"status": F.lit("error"), "error": F.col("_raised")})
    return good.filter("_raised is null").drop("_raised"), bad.unionByName(raised).drop("_raised")


def _written(spark, out: str, target: str, atlas_name: str):
    """Scans already in the output, or None; names only, no content is read."""
    from voxelframe.sources import files, keyed
    if not files.path_exists(spark, out):
        return None
    if target == "base":
        rows = keyed.scan(spark, out, files.DATASET, atlas_name)
        return rows.select(F.expr(f"substring(row_key, {len(files.KEY_PREFIX) + 1})").alias("scan_id")).distinct()
    if target == "runs":
        from voxelframe.sources import committed
        return committed.current(spark, out).select(F.col("scan").alias("scan_id"))
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(out)
    return listing.select("scan_id").distinct() if "scan_id" in listing.columns else None


def run_extraction(spark, worklist_path: str, voxel_path: str, atlas_path: str, atlas_name: str,
                   out: str, target: str = "hdd", confounds_path: str | None = None,
                   skip_existing: bool = True, standardize: bool = True, detrend: bool = False,
                   max_per_person: int | None = None, per_scan=None, run: str | None = None) -> DataFrame:
    """The extraction job end to end.

    work-list (path, person) -> scan ids from the paths -> optionally drop
    scans already written -> their voxel rows (semi join) -> atlas labels
    (unknown atlas fails first) -> region series (confounds optional) ->
    sink ('hdd' per-scan CSV files, 'runs' the same, visible all together as
    the run ``run``, 'base' keyed table).  ``per_scan`` is a function of one
    scan's region rows (scan_id, t, x0.., in order of t) that returns rows of
    the same columns, e.g. a cleaning step of the user's own; a scan for which
    it raises is reported with the exception and the others go on.

    Returns a row for every scan of the work list that was not skipped:
    scan_id, person, n_timepoints, n_gaps, status, error.  Scans with an error
    are not written; the others are.
    """
    from pyspark import StorageLevel

    from voxelframe.functions import paths
    from voxelframe.operators.aggregates import atlas_labels
    from voxelframe.operators.joins import first_n_per_key, sized_broadcast, skip_done
    from voxelframe.session import materialize
    from voxelframe.sources import files, voxel

    work = files.read_worklist(spark, worklist_path).withColumn(
        "scan_id", paths.strip_extension(paths.last_part(F.col("path"))))
    work = first_n_per_key(work, "person", ["path"], max_per_person)
    done = _written(spark, out, target, atlas_name) if skip_existing else None
    if done is not None:
        work = skip_done(work, done, ["scan_id"])
    # the work list (one row per scan) is fixed here: nothing downstream may
    # depend on the output folder this job is about to write into
    work = materialize(work.select("scan_id", "person").dropDuplicates(["scan_id"]))
    atlas = voxel.read_atlas(spark, atlas_path, atlas_name)
    labels = atlas_labels(atlas, atlas_name)
    vox = voxel.read_voxels(spark, voxel_path).join(
        sized_broadcast(work.select("scan_id")), "scan_id", "left_semi")
    conf = cols = None
    if confounds_path is not None:
        conf = spark.read.schema(voxel.CONFOUND_SCHEMA).parquet(confounds_path)
        cols = [c for c in conf.columns if c not in ("scan_id", "t")]
    wide = extract_regions(vox, atlas.select("voxel_id", "label"), labels, ["scan_id"], "t",
                           confounds=conf, confound_cols=cols or (), standardize=standardize,
                           detrend=detrend)
    # the region rows are kept for the status and the write, so the voxels
    # are read and averaged once; the status (one row per scan) is
    # checkpointed before the rows are released
    wide = wide.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, outcome = wide, None
        if per_scan is not None:
            from voxelframe.operators.guarded import guarded_groups
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema if f.name != "scan_id")
            rows, outcome = guarded_groups(wide, ["scan_id"], per_scan, schema, order_by=["t"])
        good, bad = scan_status(work, wide, conf, outcome=outcome)
        status = materialize(good.unionByName(bad))
        keep = status.filter(F.col("status") == "ok").select("scan_id", "person")
        files.route_sink(rows.join(sized_broadcast(keep), "scan_id"), target, out, "scan_id", person="person",
                         atlas=atlas_name, run=run)
        return status
    finally:
        wide.unpersist()

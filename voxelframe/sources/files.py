"""File sources and sinks: work-lists, per-scan region CSVs with
provenance, file counts, archive member listings, per-scan writers."""

from __future__ import annotations

import io
import os
import shutil
import uuid
import zipfile
from typing import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelframe.functions import paths
from voxelframe.functions.numeric import DRAW_BITS, draw

WORKLIST_SCHEMA = "path string, people_number bigint"
LABELS_SCHEMA = "person bigint, gender string"


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """Headered work-list CSV -> (path, person)."""
    df = spark.read.schema(WORKLIST_SCHEMA).option("header", True).csv(path)
    return df.withColumnRenamed("people_number", "person")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABELS_SCHEMA).option("header", True).csv(path)


def read_region_csvs(spark: SparkSession, path, schema: str | None = None,
                     t: str = "t") -> DataFrame:
    """All per-scan region CSVs under ``path`` with their provenance.

    Adds ``file`` (name), ``person`` (the number before the first '_') and
    the time ordinal ``t`` = position of the row inside its file, from the
    split offset and the monotonically increasing row id (valid directly on
    the scan, before any shuffle).  With an explicit schema the header is
    checked against it (``enforceSchema=False``): a file whose header lists
    the regions in another order fails instead of being bound by position.
    """
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", False)
    else:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    return (_numbered(df, t).withColumn("file", paths.last_part(F.col("_file_path")))
              .withColumn("person", paths.int_part(paths.last_part(F.col("_file_path")), "_", 1)))


SMALL_FILE = 64 << 10


def _numbered(df: DataFrame, t: str) -> DataFrame:
    """Rows read from files with ``_file_path`` and their position ``t`` in
    the file.  A block's rows lie in one scan partition, in file order: they
    are numbered there and shifted by the rows of the file's earlier blocks,
    so one large file is numbered by many tasks."""
    path, blk = F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_block_start").alias("_blk")
    w = Window.partitionBy("_file_path", "_blk").orderBy("_mid")
    ahead = Window.partitionBy("_file_path").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    # a file up to this size is one block and needs no counts: the listing
    # leaves it out, so small files are opened once (should the settings be
    # lowered before the rows are read, a block without a count raises)
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    whole = min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes(), SMALL_FILE)
    blocks = df.filter(F.col("_metadata.file_size") > whole).select(path, blk)
    before = (blocks.groupBy("_file_path", "_blk").agg(F.count(F.lit(1)).alias("_n"))
                .select("_file_path", "_blk", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")))
    first = F.when(F.col("_blk") == 0, F.lit(0)).otherwise(F.raise_error(F.lit("a file was cut after its reading was planned")).cast("bigint"))
    rows = df.select("*", path, blk, F.monotonically_increasing_id().alias("_mid"))
    return (rows.repartition("_file_path", "_blk").withColumn("_k", F.row_number().over(w) - 1)
              .join(before, ["_file_path", "_blk"], "left")
              .withColumn(t, (F.coalesce("_before", first) + F.col("_k")).cast("bigint"))
              .drop("_blk", "_mid", "_k", "_before"))


def read_region_csvs_any_order(spark: SparkSession, path: str, max_headers: int = 1000, t: str = "t") -> DataFrame:
    """Per-scan CSVs of numbers whose headers may list the regions in
    different orders, or lack some of them.

    Every line is matched to its file's header by a join, and each region is
    taken from the place the header gives it, so a file with header ``x1,x0``
    is never bound by position.  The numbered lines are written once, so the
    files are opened once.  Only the distinct headers reach the driver; more
    than ``max_headers`` raise."""
    from voxelframe.operators.joins import broadcast_if_small
    from voxelframe.session import materialize
    lines = materialize(_numbered(spark.read.text(path), "_line"))
    heads = lines.filter("_line = 0").select("_file_path", F.transform(F.split("value", ","), lambda c: F.trim(c)).alias("_names"))
    heads = broadcast_if_small(heads)
    orders = heads.select("_names").distinct().limit(max_headers + 1).collect()
    if len(orders) > max_headers:
        raise ValueError(f"more than {max_headers} different headers")
    cols = list(dict.fromkeys(c for r in sorted(orders, key=lambda r: (-len(r[0]), r[0])) for c in r[0]))
    parts = F.split("value", ",")
    place = [F.get(parts, F.array_position("_names", c).cast("int") - 1).try_cast("double").alias(c) for c in cols]
    file = paths.last_part(F.col("_file_path"))
    return (lines.filter("_line > 0").join(heads, "_file_path")
            .select(*place, "_file_path", (F.col("_line") - 1).alias(t), file.alias("file"),
                    paths.int_part(file, "_", 1).alias("person")))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store that Spark reads it from."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def count_files(spark: SparkSession, pattern: str) -> int:
    """Number of files matching a glob; only the path column is read.

    Spark resolves a glob folder by folder on the driver.  Here the folder
    above the first wildcard is listed, which tasks do, and the parts of each
    path are matched by filters."""
    jvm = spark.sparkContext._jvm
    parts = pattern.split("/")
    at = next((i for i, p in enumerate(parts) if any(c in p for c in "*?[{\\")), len(parts))
    base = "/".join(parts[:at])
    if base and at < len(parts) and not any(c in pattern for c in "{\\") and path_exists(spark, base):
        top = jvm.org.apache.hadoop.fs.Path(base)
        top = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(top).toString()
        names = F.split(F.substring("path", len(top) + 2, 1 << 30), "/")
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path")
        for i, p in enumerate(p for p in parts[at:] if p):
            rule = jvm.org.apache.hadoop.fs.GlobPattern(p).compiled().pattern()
            found = found.filter(F.get(names, F.lit(i)).rlike(f"^(?s:{rule})$"))
        n = found.count()
        if n:
            return n
    return spark.read.format("binaryFile").load(pattern).select("path").count()


# Fixed value: member layout of a resting-state run inside a person's
# archive (person, rest session, direction, rest session, direction).
REST_RUN_MEMBER = "%s/MNINonLinear/Results/rfMRI_%s_%s/rfMRI_%s_%s.nii.gz"


def list_archive_members(spark: SparkSession, pattern: str, read_content: bool = False) -> DataFrame:
    """(archive, member, size, status, error) for every zip under ``pattern``.

    Each archive is listed inside a task (``mapInPandas`` over the
    ``binaryFile`` listing); a corrupt archive yields one row with status
    'error' instead of failing the job.  By default only the path is read
    from the listing and the task opens the archive on the shared file
    system, which reads just the zip directory -- archives can be GBs.
    ``read_content=True`` ships the archive bytes instead (for stores the
    executors cannot open as files).
    """
    files = spark.read.format("binaryFile").load(pattern)
    return archive_members(files.select("path", "content") if read_content else files.select("path"))


def archive_members(archives: DataFrame) -> DataFrame:
    """(archive, member, size, status, error) for archives given as rows
    (path, content), or (path) alone to open them on a mounted store."""
    def open_zip(p, content):
        if content is not None:
            return zipfile.ZipFile(io.BytesIO(content))
        return zipfile.ZipFile(p[len("file:"):] if p.startswith("file:") else p)

    def members(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            found = ([], [], [], [], [])
            contents = pdf["content"] if "content" in pdf else [None] * len(pdf)
            for p, content in zip(pdf["path"], contents):
                try:
                    with open_zip(p, content) as z:
                        infos = z.infolist()
                    n = len(infos)
                    rows = ([p] * n, [i.filename for i in infos], [i.file_size for i in infos], ["ok"] * n, [None] * n)
                except Exception as e:  # noqa: BLE001 - reported per archive
                    rows = ([p], [None], [None], ["error"], [f"{type(e).__name__}: {e}"])
                for column, values in zip(found, rows):
                    column.extend(values)
            yield pd.DataFrame(dict(zip(["archive", "member", "size", "status", "error"], found)))

    return archives.mapInPandas(members, "archive string, member string, size long, status string, error string")


def rest_run_members(listing: DataFrame, directions: Sequence[str] = ("LR", "RL")) -> DataFrame:
    """Members that are the resting-state runs of the archive's own person
    and session: ``<person>/MNINonLinear/Results/rfMRI_<rest>_<dir>/...``
    where person and rest come from the archive name
    ``<person>_3T_rfMRI_<rest>_fixextended.zip``."""
    name = paths.last_part(F.col("archive"))
    person = paths.int_part(name, "_", 1)
    rest = paths.part(name, "_", 4)
    cond = None
    for d in directions:
        prefix = F.format_string(REST_RUN_MEMBER, person.cast("string"), rest, F.lit(d), rest, F.lit(d))
        e = F.col("member").startswith(prefix)
        cond = e if cond is None else (cond | e)
    return (listing.filter(F.col("status") == "ok").withColumn("person", person)
                   .withColumn("rest", rest).filter(cond))


# time points of a scan that one task writes to Parquet
PARQUET_BLOCK = 1_000_000


def write_per_scan(df: DataFrame, out: str, key: str, t: str = "t", fmt: str = "csv",
                   mode: str = "overwrite") -> None:
    """One file per scan, rows in time order, no index column.

    Rows are hash-partitioned by the scan key so each scan is written by
    exactly one task (one file per scan directory), sorted by ``t``.  Only
    the scans being written are replaced (dynamic partition overwrite), so
    a retried or incremental run never removes other scans.  One file per
    scan means one writer task per scan: that is the CSV contract.  Parquet
    output keeps ``t`` (its rows have no order of their own) and is spread
    over blocks of ``PARQUET_BLOCK`` time points, so a long scan has several
    writers.

    On a mounted store the tasks write the CSV files themselves (lines as
    Spark's writer has them) and put them into place once all are written:
    Spark's committer moves scan after scan on the driver.
    """
    from voxelframe.session import mounted_folder
    mounted = mounted_folder(df.sparkSession, out)
    if fmt == "csv" and mode in ("overwrite", "append") and mounted:
        return _write_files(df, mounted, key, t, replace=mode == "overwrite")
    if fmt == "csv":
        d = df.repartition(key).sortWithinPartitions(key, t).drop(t)
    else:
        d = df.repartition(F.col(key), F.floor(F.col(t) / F.lit(PARQUET_BLOCK))).sortWithinPartitions(key, t)
    w = (d.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(key))
    if fmt == "csv":
        w.option("header", True).csv(out)
    else:
        w.parquet(out)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"      # Spark's folder of a null or empty key


def _folder(key: str, value: str) -> str:
    """``key=value`` escaped as Spark escapes its partition folders."""
    def clean(s):
        return "".join(f"%{ord(c):02X}" if c < " " or c in "\"#%'*/:=?\\{[]^\x7f" else c for c in s)
    return f"{clean(key)}={clean(value)}"


def _write_files(df: DataFrame, out: str, key: str, t: str, replace: bool) -> None:
    """A CSV file per scan, written by the task that holds the scan's rows as a
    draft; then tasks move the drafts into the scans' folders, in place of what
    is there (``replace``) or beside it."""
    from voxelframe.session import materialize
    spark = df.sparkSession
    cols = [c for c in df.columns if c not in (key, t)]
    run = uuid.uuid4().hex
    drafts, name = os.path.join(out, f".drafts-{run}"), f"part-{run}.csv"
    # the names as Spark's writer quotes them
    head = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(cols)]))).first()[0]
    scan = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(NO_VALUE))
    line = F.to_csv(F.struct(*[F.col(c) for c in cols]))
    if len(cols) == 1:          # an empty line is no string to to_csv: a second column is written and cut off
        line = F.expr("substring(_two, 1, length(_two) - 2)")
        df = df.withColumn("_two", F.to_csv(F.struct(F.col(cols[0]), F.lit(0).alias("_0"))))
    rows = (df.select(scan.alias("_scan"), F.col(key).alias("_key"), F.col(t).alias("_t"), line.alias("_line"))
              .repartition("_scan").sortWithinPartitions("_scan", "_key", "_t").select("_scan", "_line"))

    def write(batches):
        own = os.path.join(drafts, uuid.uuid4().hex)        # of this attempt
        os.makedirs(own)
        last, n, f = None, 0, None
        try:
            for pdf in batches:
                scans, lines, listed = pdf["_scan"].to_list(), pdf["_line"].to_list(), []
                starts = [i for i, s in enumerate(scans) if i == 0 or s != scans[i - 1]]
                for a, b in zip(starts, [*starts[1:], len(scans)]):
                    if f is None or scans[a] != last:
                        if f is not None:
                            f.close()
                        last, n = scans[a], n + 1
                        f = open(os.path.join(own, f"{n}.csv"), "w", newline="", encoding="utf-8")
                        f.write(head + "\n")
                        listed.append((_folder(key, last), os.path.join(own, f"{n}.csv")))
                    # a lone null is an empty line, which Spark leaves out
                    f.write("".join(line + "\n" for line in lines[a:b] if line))
                yield pd.DataFrame(listed, columns=["folder", "draft"])
        finally:
            if f is not None:
                f.close()

    def place(batches):
        for pdf in batches:
            for folder, draft in zip(pdf["folder"], pdf["draft"]):
                to = os.path.join(out, folder)
                os.makedirs(to, exist_ok=True)
                try:
                    os.replace(draft, os.path.join(to, name))
                except FileNotFoundError:
                    if not os.path.exists(os.path.join(to, name)):      # else moved by an earlier attempt
                        raise
                for other in os.listdir(to) if replace else ():
                    if other != name:
                        path = os.path.join(to, other)
                        shutil.rmtree(path) if os.path.isdir(path) else os.remove(path)
            yield pd.DataFrame({"n": [len(pdf)]})
    os.makedirs(drafts)
    try:
        written = materialize(rows.mapInPandas(write, "folder string, draft string"))
        written.mapInPandas(place, "n bigint").agg(F.sum("n")).collect()
    finally:
        shutil.rmtree(drafts, ignore_errors=True)


# fixed values of the keyed sink
KEY_PREFIX = "HCP_"
DATASET = "HCP"
ATLAS = "harvard_oxford"


def route_sink(df: DataFrame, target: str, out: str, key: str, t: str = "t", person: str | None = None,
               dataset: str = DATASET, atlas: str = ATLAS, version: int | None = None, run: str | None = None) -> None:
    """Write regions to files (``hdd``), to files that become visible all
    together as the run ``run`` (``runs``), or to the keyed table (``base``).

    The keyed row of a scan has the key prefix plus the scan's name, the
    number in column ``person`` (default: the number the scan's name starts
    with), the given atlas, and a version that rises from run to run
    (default: the clock in microseconds); long series are several chunks of
    the same key."""
    if target == "hdd":
        write_per_scan(df.drop(person) if person else df, out, key, t)
    elif target == "runs":
        from voxelframe.sources import committed
        if run is None:
            raise ValueError("a committed write needs the name of its run")
        committed.write_run(df.drop(person) if person else df, out, run, key, t)
    elif target == "base":
        import time
        from voxelframe.functions.json_cells import to_cells
        from voxelframe.sources import keyed
        cols = [c for c in df.columns if c not in (key, t, person)]
        cells = to_cells(df, [key, person] if person else [key], t, cols)
        who = F.col(person) if person else paths.int_part(F.col(key).cast("string"), "_", 1)
        rows = keyed.make_rows(cells, F.concat(F.lit(KEY_PREFIX), F.col(key).cast("string")), who,
                               F.lit(dataset), F.lit(atlas), F.col("roi"),
                               F.lit(int(time.time() * 1e6) if version is None else version), chunk=F.col("chunk"))
        keyed.put(rows, out)
    else:
        raise ValueError(f"unknown target {target!r}")


def random_columns(df: DataFrame, id_cols: Sequence[str], names: Sequence[str], seed: int = 0) -> DataFrame:
    """Uniform [0, 1) columns, one seeded stream per column, drawn from each
    row's identity: the same in every run and partitioning."""
    ids = [F.col(c) for c in id_cols]
    return df.select("*", *[(draw(seed + i, *ids) / F.lit(float(1 << DRAW_BITS))).alias(c) for i, c in enumerate(names)])

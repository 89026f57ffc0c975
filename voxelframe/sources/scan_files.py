"""Per-scan region CSVs and archives as Spark data sources.

Both plan their partitions by file: files are listed once, in order of name,
and packed into partitions of about ``partition_bytes``; a task opens its files
on the mounted store.  A file that cannot be read as what it should be gives
one row with status 'error' and the reason, and the others go on.

``region_files``  (scan, t, the columns of the schema given, status, error):
    a headered CSV per scan; columns are taken by their header, in any order,
    and may lack some of the schema's; t is the row's position; the scan is the
    file's name without its extension.  A damaged file gives no other rows, so
    a file's rows are held until its end.
``archive_members``  (archive, member, size, status, error): the members of
    zip archives, from their directories alone.
"""

from __future__ import annotations

import csv
import glob
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

REGIONS, MEMBERS = "region_files", "archive_members"
PARTITION_BYTES = 64 << 20
OPEN_BYTES = 64 << 10           # opening a small file costs as much as reading these
TASKS_PER_CORE, BATCH_ROWS = 4, 8096
MEMBER_SCHEMA = "archive string, member string, size bigint, status string, error string"


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _mounted(pattern: str) -> str:
    pattern = pattern[len("file:"):] if pattern.startswith("file:") else pattern
    if "://" in pattern:
        raise ValueError(f"{pattern}: files must be on a mounted store")
    return "/" + pattern.lstrip("/") if pattern.startswith("//") else pattern


def packed(pattern: str, partition_bytes: int, cost=os.path.getsize, cores: int = 0) -> list[Files]:
    """Files of a pattern in order, as many to a partition as fit; with
    ``cores``, at most their even share of all files' cost."""
    found = [(p, cost(p)) for p in sorted(f for f in glob.glob(_mounted(pattern), recursive=True) if os.path.isfile(f))]
    if cores:
        partition_bytes = min(partition_bytes, -(-sum(n for _, n in found) // cores))
    parts, size = [], 0
    for p, n in found:
        if not parts or size + n > partition_bytes:
            parts.append(Files([]))
            size = 0
        parts[-1].paths.append(p)
        size += n
    return parts or [Files([])]


class RegionReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.pattern, self.bytes = options["path"], int(options.get("partition_bytes", PARTITION_BYTES))
        self.cores = int(options.get("cores", 0))
        self.by_folder = options.get("scan", "file") == "folder"
        self.columns = [f.name for f in schema.fields if f.name not in ("scan", "t", "status", "error")]
        self.order = [f.name for f in schema.fields]

    def partitions(self):
        if not self.cores:
            return packed(self.pattern, self.bytes)
        return packed(self.pattern, self.bytes, lambda p: os.path.getsize(p) + OPEN_BYTES, self.cores)

    def read(self, partition):
        for path in partition.paths:
            folder, name = os.path.split(path)
            scan = os.path.basename(folder).split("=", 1)[-1] if self.by_folder else os.path.splitext(name)[0]
            try:
                rows = [{**r, "scan": scan, "t": t, "status": "ok"} for t, r in enumerate(self._rows(path))]
            except Exception as e:  # noqa: BLE001 - a damaged file is a row
                rows = [{"scan": scan, "status": "error", "error": f"{type(e).__name__}: {e}"}]
            for r in rows:
                yield tuple(r.get(c) for c in self.order)

    def _rows(self, path):
        with open(path, newline="", encoding="utf-8") as f:
            lines = csv.reader(f, strict=True)
            head = [c.strip() for c in next(lines, [])]
            if not head:
                raise ValueError("no header")
            if len(set(head)) < len(head):
                raise ValueError("a column is there twice")
            unknown = [c for c in head if c not in self.columns]
            if unknown:
                raise ValueError(f"unknown columns {unknown}")
            for line in lines:
                if len(line) != len(head):
                    raise ValueError(f"line {lines.line_num}: {len(line)} values for {len(head)} columns")
                yield {c: float(v) if v.strip() else None for c, v in zip(head, line)}


class RegionFiles(DataSource):
    @classmethod
    def name(cls):
        return REGIONS

    def reader(self, schema):
        return RegionReader(self.options, schema)


class Folders(InputPartition):
    def __init__(self, paths: list[str], name: str):
        self.paths, self.name = paths, name


class MemberReader(DataSourceReader):
    def __init__(self, options):
        self.pattern, self.most = options["path"], int(options.get("partition_files", 0))
        self.cores = int(options.get("cores", 1))

    def partitions(self):
        # an archive's directory is read, whatever its size
        if self.most:
            return packed(self.pattern, self.most, cost=lambda p: 1)
        folder, name = os.path.split(_mounted(self.pattern))
        if "**" in folder or name == "**" or not glob.has_magic(folder):
            return packed(self.pattern, 1 << 62, cost=lambda p: 1, cores=TASKS_PER_CORE * self.cores)
        # many folders: only they are listed here, and the tasks list what they hold
        folders = sorted(f for f in glob.glob(folder) if os.path.isdir(f))
        each = max(1, -(-len(folders) // (TASKS_PER_CORE * self.cores)))
        return [Folders(folders[i:i + each], name) for i in range(0, len(folders), each)] or [Files([])]

    def read(self, partition):
        paths = partition.paths
        if isinstance(partition, Folders):
            paths = (p for f in paths for p in sorted(glob.glob(os.path.join(glob.escape(f), partition.name))) if os.path.isfile(p))
        found = ([], [], [], [], [])
        for path in paths:
            try:
                with zipfile.ZipFile(path) as z:
                    infos = z.infolist()
                n = len(infos)
                rows = ([path] * n, [i.filename for i in infos], [i.file_size for i in infos], ["ok"] * n, [None] * n)
            except Exception as e:  # noqa: BLE001 - a damaged archive is a row
                rows = ([path], [None], [None], ["error"], [f"{type(e).__name__}: {e}"])
            for column, values in zip(found, rows):
                column.extend(values)
            if len(found[0]) >= BATCH_ROWS:
                yield _member_batch(found)
                found = ([], [], [], [], [])
        yield _member_batch(found)


def _member_batch(columns):
    import pyarrow as pa
    types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["archive", "member", "size", "status", "error"])


class ArchiveMembers(DataSource):
    @classmethod
    def name(cls):
        return MEMBERS

    def schema(self):
        return MEMBER_SCHEMA

    def reader(self, schema):
        return MemberReader(self.options)


def read_region_files(spark: SparkSession, pattern: str, columns: str, partition_bytes: int | None = None,
                      scan: str = "file") -> DataFrame:
    """(scan, t, ``columns``, status, error) of the CSVs that match a glob.
    Without ``partition_bytes`` every core has work, however small the files."""
    spark.dataSource.register(RegionFiles)
    r = spark.read.format(REGIONS).schema(f"scan string, t bigint, {columns}, status string, error string")
    if partition_bytes is None:
        r = r.option("cores", spark.sparkContext.defaultParallelism)
    else:
        r = r.option("partition_bytes", partition_bytes)
    return r.option("scan", scan).load(pattern)


def read_archive_members(spark: SparkSession, pattern: str, partition_files: int | None = None) -> DataFrame:
    """(archive, member, size, status, error) of the zip files that match a
    glob.  Without ``partition_files`` there are a few partitions a core, of
    whole folders if the pattern names many."""
    spark.dataSource.register(ArchiveMembers)
    r = spark.read.format(MEMBERS).option("cores", spark.sparkContext.defaultParallelism)
    return (r if partition_files is None else r.option("partition_files", partition_files)).load(pattern)

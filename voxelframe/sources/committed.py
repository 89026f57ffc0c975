"""All-or-nothing sink of per-scan CSV files, as a Spark data source.

A write is a run.  Its tasks write one file per scan under ``data`` and list
them in a part of the run's manifest; only when all tasks have finished does
the driver put the run's head in place, by one rename.  Readers take the files
in the parts that heads name, so a run that fails leaves nothing to see,
whatever its tasks have written by then, and files of killed attempts are never
read.  A run has a name: writing it again, after a failure or by mistake,
changes nothing once its head is there.

A head holds (run, sequence, parts), a part a JSON line (scan, file, rows) per
scan; of several runs that wrote a scan the one with the largest sequence
counts.  Only part names pass the driver.  The folder must be mounted where
the driver and the executors run.
"""

from __future__ import annotations

import csv
import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "committed_scans"
DATA, MANIFESTS = "data", "manifests"
PARTS = "parts"
HEAD_SCHEMA = "run string, sequence bigint, parts array<string>"
PART_SCHEMA = "scan string, file string, rows bigint"


def _local(path: str) -> str:
    path = path[len("file:"):] if path.startswith("file:") else path
    if "://" in path:
        raise ValueError(f"{path}: the committed sink needs a mounted folder")
    return "/" + path.lstrip("/") if path.startswith("//") else path


@dataclass
class Part(WriterCommitMessage):
    name: str            # of the file that lists a task's scans; empty: it wrote none


class ScanWriter(DataSourceWriter):
    def __init__(self, path: str, run: str, key: str, drop: str, names: list[str]):
        self.path, self.run, self.key, self.names = _local(path), run, key, names
        self.kept = [n for n in names if n not in (key, drop)]

    def _at(self, *names) -> str:
        return os.path.join(self.path, *names)

    @property
    def head(self) -> str:
        return self._at(MANIFESTS, f"{self.run}.json")

    def write(self, iterator):
        """Rows sorted by scan -> a file per scan, with names of this attempt."""
        if os.path.exists(self.head):            # the run is there already
            for _ in iterator:
                pass
            return Part("")
        os.makedirs(self._at(DATA), exist_ok=True)
        os.makedirs(self._at(MANIFESTS, PARTS), exist_ok=True)
        part = f"{self.run}-{uuid.uuid4().hex}.jsonl"
        scan, out, n, any_row = None, None, 0, False
        with open(self._at(MANIFESTS, PARTS, part), "w", encoding="utf-8") as listed:
            def close():
                out.close()
                listed.write(json.dumps({"scan": scan, "file": file, "rows": n}) + "\n")
            try:
                for row in iterator:
                    if not any_row or row[self.key] != scan:
                        if any_row:
                            close()
                        any_row, scan, n, file = True, row[self.key], 0, f"{uuid.uuid4().hex}.csv"
                        out = open(self._at(DATA, file), "w", newline="", encoding="utf-8")
                        if scan is None:
                            raise ValueError("a row without a scan")
                        sheet = csv.writer(out)
                        sheet.writerow(self.kept)
                    sheet.writerow([row[c] for c in self.kept])
                    n += 1
                if any_row:
                    close()
            except BaseException:
                if out is not None:
                    close()
                listed.close()
                self._remove(part)
                raise
        return Part(part if any_row else "")

    def _remove(self, part: str) -> None:
        """A part and the files it lists; what cannot be removed is not read anyway."""
        try:
            with open(self._at(MANIFESTS, PARTS, part), encoding="utf-8") as f:
                files = [json.loads(line)["file"] for line in f]
            for file in files:
                os.remove(self._at(DATA, file))
            os.remove(self._at(MANIFESTS, PARTS, part))
        except OSError:
            pass

    def commit(self, messages) -> None:
        parts = [m.name for m in messages if m is not None and m.name]
        os.makedirs(self._at(MANIFESTS), exist_ok=True)
        if os.path.exists(self.head):
            for part in parts:
                self._remove(part)
            return
        sequence = 0
        for name in os.listdir(self._at(MANIFESTS)):
            if name.endswith(".json") and not name.startswith("."):
                with open(self._at(MANIFESTS, name), encoding="utf-8") as f:
                    sequence = max(sequence, json.load(f)["sequence"])
        draft = self._at(MANIFESTS, f".{self.run}-{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as f:
            json.dump({"run": self.run, "sequence": sequence + 1, "parts": parts}, f)
        os.replace(draft, self.head)

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None and m.name:
                self._remove(m.name)


class CommittedScans(DataSource):
    """Write side; options: path, run, key, drop (a column that only orders)."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        o = self.options
        return ScanWriter(o["path"], o["run"], o["key"], o.get("drop", ""), schema.names)


def write_run(df: DataFrame, path: str, run: str, key: str, t: str = "t") -> None:
    """Write every scan of ``df``, rows in the order of ``t`` (which is not
    written), as one run that is visible whole or not at all."""
    if not run or any(c in run for c in "/\\\0") or run.startswith("."):
        raise ValueError(f"not a run's name: {run!r}")
    spark = df.sparkSession
    spark.dataSource.register(CommittedScans)
    rows = df.withColumn(key, F.col(key).cast("string")).repartition(key).sortWithinPartitions(key, t)
    (rows.write.format(FORMAT).mode("append").option("path", path).option("run", run).option("key", key)
         .option("drop", t).save())


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(run, sequence, scan, file, rows) of all committed runs."""
    from voxelframe.operators.joins import sized_broadcast
    folder = os.path.join(path, MANIFESTS)
    heads = spark.createDataFrame([], HEAD_SCHEMA)
    listed = spark.createDataFrame([], PART_SCHEMA).withColumn("part", F.lit(""))
    if os.path.isdir(_local(folder)):
        heads = spark.read.schema(HEAD_SCHEMA).option("pathGlobFilter", "*.json").json(folder)
    if os.path.isdir(_local(os.path.join(folder, PARTS))):
        listed = spark.read.schema(PART_SCHEMA).json(os.path.join(folder, PARTS)).withColumn("part", F.col("_metadata.file_name"))
    named = heads.select("run", "sequence", F.explode("parts").alias("part"))
    return listed.join(sized_broadcast(named), "part").select("run", "sequence", "scan", "file", "rows")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The file that counts for every scan.  A run in which two tasks wrote
    the same scan raises."""
    order = F.struct("sequence", "run")
    newest = manifests(spark, path).groupBy("scan", "run", "sequence").agg(
        F.count(F.lit(1)).alias("_n"), F.first("file").alias("file"), F.first("rows").alias("rows"))
    newest = newest.groupBy("scan").agg(F.max_by(F.struct("run", "file", "rows", "_n"), order).alias("m"))
    file = F.when(F.col("m._n") == 1, F.col("m.file")).otherwise(
        F.raise_error(F.concat(F.lit("several files of one run for the scan "), F.col("scan"))))
    return newest.select("scan", "m.run", file.alias("file"), "m.rows")


def read_runs(spark: SparkSession, path: str, schema: str, t: str = "t") -> DataFrame:
    """Rows of the committed scans: the columns of ``schema``, ``scan``, and the
    position ``t`` in the file.  Files that no manifest lists are not taken."""
    from voxelframe.operators.joins import broadcast_if_small
    from voxelframe.sources.files import read_region_csvs
    known = broadcast_if_small(current(spark, path).select("scan", "file"))
    if not known.limit(1).count():
        return spark.createDataFrame([], f"{schema}, {t} bigint, scan string")
    rows = read_region_csvs(spark, os.path.join(path, DATA), schema, t)
    names = [f.name for f in rows.schema.fields if f.name not in ("file", "person", "_file_path")]
    return rows.join(known, "file").select(*names, "scan")

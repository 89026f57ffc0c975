"""Queries over sources and sinks: each writes what it reads from the
driver's tables into the shared folder and lists or reads it back."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from voxelframe.functions.json_cells import from_cells
from voxelframe.functions.numeric import DRAW_BITS, r6, random_int, softplus, sql_draw, sql_r6, uniform_constant
from voxelframe.functions.regions import to_long
from voxelframe.operators import formula
from voxelframe.operators.aggregates import atlas_labels, region_means
from voxelframe.operators.guarded import guarded_rows
from voxelframe.operators.joins import broadcast_if_small, first_n_per_key
from voxelframe.plans.extract import scan_status
from voxelframe.plans.q_stats import _FIT_SQL, FORMULAS
from voxelframe.plans.registry import query
from voxelframe.plans.stand_ins import ATLAS, DATASET, REGION_COLS, ROW_KEY_PREFIX, SERIES_SQL, series
from voxelframe.session import table_path
from voxelframe.sources import committed, compacted, files, keyed, scan_files, voxel
from voxelframe.tables import small_table, table


def _scratch(spark, name: str) -> str:
    return table_path(spark, f"{name}_{uuid.uuid4().hex}")


# ------------------------------------------------------------- files
ARCHIVE_NAME = "%d_3T_rfMRI_REST%d_fixextended.zip"
ARCHIVE_PERSONS = 256           # persons whose archives share a folder


@query("worklist_csv", """SELECT '/data/' || c_custkey || '_3T_rfMRI_REST' || (c_nationkey % 2 + 1) || '_fixextended.zip' AS path,
  c_custkey AS person FROM customer""")
def worklist_csv(spark, sf_dir):
    """A headered work-list CSV written from the customers and read back."""
    c = table(spark, sf_dir, "customer")
    out = _scratch(spark, "worklist")
    name = F.format_string("/data/" + ARCHIVE_NAME, "c_custkey", F.col("c_nationkey") % 2 + 1)
    c.select(name.alias("path"), F.col("c_custkey").alias("people_number")).write.option("header", True).csv(out)
    return files.read_worklist(spark, out).select("path", "person")


@query("file_count", "SELECT count(DISTINCT user_id) AS n_files FROM events")
def file_count(spark, sf_dir):
    """Files in a folder that holds one CSV per scan."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    out = _scratch(spark, "per_scan")
    files.write_per_scan(s.select("user_id", "t", "value"), out, "user_id")
    return small_table(spark, [(files.count_files(spark, out + "/*/*.csv"),)], "n_files bigint")


@query("committed_runs", f"""SELECT CAST(user_id AS VARCHAR) AS scan, t, CASE WHEN user_id % 3 = 0 THEN value + 1 ELSE value END AS value,
  CASE WHEN user_id % 3 = 0 THEN 'second' ELSE 'first' END AS run FROM ({SERIES_SQL})""")
def committed_runs(spark, sf_dir):
    """Per-scan files written as runs that are visible whole: a first run, the
    same run again with other values (nothing is written twice), and a second
    one that replaces every third scan."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value")).select("user_id", "t", "value")
    out = _scratch(spark, "runs")
    more = s.withColumn("value", F.col("value") + 1)
    files.route_sink(s, "runs", out, "user_id", run="first")
    files.route_sink(more, "runs", out, "user_id", run="first")
    files.route_sink(more.filter(F.col("user_id") % 3 == 0), "runs", out, "user_id", run="second")
    rows = committed.read_runs(spark, out, "value double")
    return rows.join(committed.current(spark, out).select("scan", "run"), "scan").select("scan", "t", "value", "run")


@query("csv_any_order", f"SELECT user_id, t, value FROM ({SERIES_SQL})")
def csv_any_order(spark, sf_dir):
    """Region CSVs whose headers list their columns in two orders."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    out = _scratch(spark, "any_order")
    for odd, cols in ((0, ["value", "t"]), (1, ["t", "value"])):
        part = s.filter(F.col("user_id") % 2 == odd).select("user_id", "t", *[F.col(c).alias(f"{c}_") for c in cols])
        part = part.withColumnsRenamed({"value_": "value", "t_": "position"})
        files.write_per_scan(part, out, "user_id", mode="append")
    back = files.read_region_csvs_any_order(spark, out)
    user = F.regexp_extract("_file_path", "user_id=([0-9]+)", 1).cast("bigint")
    # the position written as a column agrees with the place in the file
    return back.filter(F.col("position") == F.col("t")).select(user.alias("user_id"), "t", "value")


@query("region_file_source", f"""WITH s AS ({SERIES_SQL})
SELECT CAST(user_id AS VARCHAR) AS scan, t, value, 'ok' AS status, NULL AS error FROM s WHERE user_id % 10 <> 0
UNION ALL SELECT DISTINCT CAST(user_id AS VARCHAR), NULL, NULL, 'error',
  'ValueError: could not convert string to float: ' || chr(39) || 'lost' || chr(39) FROM s WHERE user_id % 10 = 0""")
def region_file_source(spark, sf_dir):
    """Per-scan CSVs read by the data source that plans by file; every tenth
    scan's file is damaged and is one row that says so."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    out = _scratch(spark, "region_files")
    value = F.when(F.col("user_id") % 10 == 0, F.lit("lost")).otherwise(F.col("value").cast("string"))
    files.write_per_scan(s.select("user_id", "t", value.alias("value")), out, "user_id")
    return scan_files.read_region_files(spark, out + "/*/*.csv", "value double", scan="folder")


@query("random_columns", "SELECT c_custkey, " + ", ".join(
    f"{sql_draw(7 + i, 'c_custkey')} / CAST({1 << DRAW_BITS} AS DOUBLE) AS r{i}" for i in range(3)) + " FROM customer")
def random_columns(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return files.random_columns(c, ["c_custkey"], ["r0", "r1", "r2"], seed=7)


_MEMBER_SQL = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderkey % 2 + 1 AS rest FROM orders),
l AS (SELECT o.*, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'LR' WHEN 1 THEN 'RL' ELSE 'XX' END AS dir
  FROM lineitem JOIN o ON l_orderkey = o_orderkey)
SELECT o_custkey AS person, 'REST' || rest AS rest, o_custkey || '/MNINonLinear/Results/rfMRI_REST' || rest || '_' || dir ||
  '/rfMRI_REST' || rest || '_' || dir || '.nii.gz/' || l_linenumber AS member, CAST(l_linenumber AS BIGINT) AS size,
  o_orderkey FROM l WHERE o_orderkey % 10 <> 0 AND dir <> 'XX'"""


def zip_bytes(names, sizes) -> bytes:
    """A zip archive of stored members ``x`` times their size, laid out as
    ``zipfile`` writes it; it took most of the time for small members."""
    import io
    import struct
    import warnings
    import zipfile
    import zlib
    if len(names) >= 1 << 16 or sum(sizes) + sum(len(n) for n in names) * 8 >= 1 << 30:
        buf = io.BytesIO()
        with warnings.catch_warnings(), zipfile.ZipFile(buf, "w") as z:
            warnings.simplefilter("ignore")        # repeated lines are repeated members
            for name, size in zip(names, sizes):
                z.writestr(name, b"x" * int(size))
        return buf.getvalue()
    out, listed, at = [], [], 0
    for name, size in zip(names, sizes):
        data, name = b"x" * int(size), name.encode()
        # version 2.0, names in UTF-8, stored, 1980-01-01
        head = struct.pack("<HHHHHLLLHH", 20, 0x800, 0, 0, 33, zlib.crc32(data), len(data), len(data), len(name), 0)
        listed.append(b"PK\x01\x02\x14\x03" + head + struct.pack("<HHHLL", 0, 0, 0, 0o600 << 16, at) + name)
        out.append(b"PK\x03\x04" + head + name + data)
        at += len(out[-1])
    size = sum(map(len, listed))
    return b"".join([*out, *listed, struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, len(names), len(names), size, at, 0)])


@query("zip_members", _MEMBER_SQL)
def zip_members(spark, sf_dir):
    """An archive per order with a member per line (every tenth archive is
    damaged); members that are the person's own runs are listed."""
    import pandas as pd
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 2 + 1).alias("rest"))
    turn = F.element_at(F.array(*[F.lit(d) for d in ("LR", "RL", "XX")]), F.col("l_linenumber") % 3 + 1)
    run = F.format_string(files.REST_RUN_MEMBER, F.col("o_custkey").cast("string"), F.concat(F.lit("REST"), "rest"), turn,
                          F.concat(F.lit("REST"), "rest"), turn)
    # at most a few lines per order
    packs = (table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("o_orderkey", "o_custkey", "rest").agg(F.collect_list(F.struct(
                 F.concat(run, F.lit("/"), F.col("l_linenumber").cast("string")).alias("name"), "l_linenumber")).alias("m"))
             .select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.lit("/"),
                                            F.format_string(ARCHIVE_NAME, "o_custkey", "rest")).alias("path"),
                     F.col("m.name").alias("names"), F.col("m.l_linenumber").alias("sizes")))

    def pack(batches):
        for pdf in batches:
            blobs = [zip_bytes(names, sizes) if key % 10 else b"no archive"
                     for key, names, sizes in zip(pdf["o_orderkey"], pdf["names"], pdf["sizes"])]
            yield pd.DataFrame({"path": pdf["path"], "content": blobs})
    out = _scratch(spark, "archives")
    packs.mapInPandas(pack, "path string, content binary").write.parquet(out)
    found = files.rest_run_members(files.archive_members(spark.read.schema("path string, content binary").parquet(out)))
    return found.select("person", "rest", "member", "size",
                        F.split("archive", "/")[0].cast("bigint").alias("o_orderkey"))


@query("archive_member_source", """WITH l AS (SELECT o_custkey, o_orderkey % 2 + 1 AS rest, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey AS person, rest, l_orderkey || '/' || l_linenumber AS member, CAST(l_linenumber AS BIGINT) AS size, 'ok' AS status,
  NULL AS error FROM l WHERE o_custkey % 10 <> 0
UNION ALL SELECT DISTINCT o_custkey, rest, NULL, NULL, 'error', 'BadZipFile: File is not a zip file' FROM l WHERE o_custkey % 10 = 0""")
def archive_member_source(spark, sf_dir):
    """Archives of every person's two rest sessions with a member per line,
    written by tasks and listed by the data source that plans by archive;
    every tenth person's are damaged."""
    import os

    import pandas as pd
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 2 + 1).alias("rest"))
    lines = table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    name = F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    packs = lines.groupBy("o_custkey", "rest").agg(F.collect_list(F.struct(name.alias("name"), "l_linenumber")).alias("m"))
    packs = packs.select("o_custkey", "rest", F.col("m.name").alias("names"), F.col("m.l_linenumber").alias("sizes"))
    out = _scratch(spark, "archives")
    folder = out[len("file:"):] if out.startswith("file:") else out

    def write(batches):
        os.makedirs(folder, exist_ok=True)
        made = set()
        for pdf in batches:
            for person, rest, names, sizes in zip(pdf["o_custkey"], pdf["rest"], pdf["names"], pdf["sizes"]):
                some = os.path.join(folder, f"{person // ARCHIVE_PERSONS}")
                if some not in made:
                    os.makedirs(some, exist_ok=True)
                    made.add(some)
                path = os.path.join(some, ARCHIVE_NAME % (person, rest))
                draft = f"{path}.{uuid.uuid4().hex}"
                with open(draft, "wb") as f:
                    f.write(zip_bytes(names, sizes) if person % 10 else b"no archive")
                os.replace(draft, path)         # a repeated task writes the same again
            yield pd.DataFrame({"n": [len(pdf)]})
    packs.mapInPandas(write, "n bigint").agg(F.sum("n")).collect()
    found = scan_files.read_archive_members(spark, out + "/*/*.zip")
    base = F.element_at(F.split("archive", "/"), -1)
    return found.select(F.regexp_extract(base, "^([0-9]+)_", 1).cast("bigint").alias("person"),
                        F.regexp_extract(base, "REST([0-9])", 1).cast("bigint").alias("rest"), "member", "size", "status", "error")


@query("atlas_regions", f"""WITH a AS (SELECT p_partkey, p_size % 6 AS label FROM part WHERE p_brand = 'Brand#1' AND p_size % 6 <> 0),
r AS (SELECT l_suppkey, label, avg(l_quantity) AS v FROM lineitem JOIN a ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT l_suppkey, {", ".join(f"{sql_r6(f'max(v) FILTER (WHERE label = {i})')} AS x{i - 1}" for i in range(1, 6))}
FROM r GROUP BY 1""")
def atlas_regions(spark, sf_dir):
    """The parts of one brand as an atlas, stored and looked up by name; line
    quantities averaged per label."""
    p = table(spark, sf_dir, "part")
    out = _scratch(spark, "atlas")
    p.select(F.col("p_brand").alias("atlas"), F.col("p_partkey").alias("voxel_id"),
             (F.col("p_size") % 6).cast("int").alias("label")).write.parquet(out)
    atlas = voxel.read_atlas(spark, out, "Brand#1")
    labels = atlas_labels(atlas, "Brand#1")
    vox = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_partkey").alias("voxel_id"), "l_quantity")
    wide = region_means(vox, atlas.select("voxel_id", "label"), ["l_suppkey"], "label", "l_quantity", labels)
    cols = [r6(F.col(f"x{i}")).alias(f"x{i}") if i < len(labels) else F.lit(None).cast("double").alias(f"x{i}")
            for i in range(5)]
    return wide.select("l_suppkey", *cols)


# ------------------------------------------------------------- keyed table
SECOND_PUT, TOMBSTONE = 1_000_000_000, 1_000_000_000
_KEY = f"'{ROW_KEY_PREFIX}' || CAST(o_custkey AS VARCHAR)"


@query("keyed_table", f"""WITH puts AS (
  SELECT {_KEY} AS row_key, o_custkey, o_orderpriority AS roi, o_orderkey AS version FROM orders
  UNION ALL SELECT {_KEY}, o_custkey, o_orderstatus, o_orderkey + {SECOND_PUT} FROM orders WHERE o_orderstatus = 'F'),
newest AS (SELECT row_key, arg_max(o_custkey, version) AS person, arg_max(roi, version) AS roi, max(version) AS version FROM puts GROUP BY 1)
SELECT row_key, CAST(person AS VARCHAR) AS person, '{DATASET}' AS dataset, '{ATLAS}' AS atlas, roi, version FROM newest
WHERE row_key NOT IN (SELECT '{ROW_KEY_PREFIX}' || c_custkey FROM customer WHERE c_acctbal < 0) OR version > {TOMBSTONE}""")
def keyed_table(spark, sf_dir):
    """A keyed table created, put twice, deleted from, scanned and read."""
    path, dead = _scratch(spark, "keyed"), _scratch(spark, "tombstones")
    keyed.create_table(spark, path)
    o = table(spark, sf_dir, "orders")

    def rows(df, roi, version):
        return keyed.make_rows(df, F.concat(F.lit(ROW_KEY_PREFIX), F.col("o_custkey").cast("string")), F.col("o_custkey"),
                               F.lit(DATASET), F.lit(ATLAS), F.col(roi), version)
    keyed.put(rows(o, "o_orderpriority", F.col("o_orderkey")), path)
    keyed.put(rows(o.filter(F.col("o_orderstatus") == "F"), "o_orderstatus", F.col("o_orderkey") + SECOND_PUT), path)
    gone = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    keyed.delete(spark, gone.select(F.concat(F.lit(ROW_KEY_PREFIX), F.col("c_custkey").cast("string")).alias("row_key")),
                 F.lit(TOMBSTONE), dead)
    view = keyed.latest(keyed.scan(spark, path, DATASET, ATLAS), spark.read.schema(keyed.TOMBSTONE_SCHEMA).parquet(dead))
    return keyed.flatten(view)


THIRD_PUT = 2_000_000_000
_COMPACTED_SQL = f"""WITH puts AS (
  SELECT {_KEY} AS row_key, o_custkey, o_orderpriority AS roi, o_orderkey AS version FROM orders
  UNION ALL SELECT {_KEY}, o_custkey, o_orderstatus, o_orderkey + {SECOND_PUT} FROM orders WHERE o_orderstatus = 'F'),
gone AS (SELECT '{ROW_KEY_PREFIX}' || c_custkey AS row_key, {TOMBSTONE} AS version FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT '{ROW_KEY_PREFIX}' || c_custkey, {THIRD_PUT} FROM customer WHERE c_custkey % 11 = 0),
late AS (SELECT {_KEY} AS row_key, o_custkey, 'late' AS roi, o_orderkey + CASE WHEN o_custkey % 2 = 0 THEN {THIRD_PUT} ELSE 1 END AS version
  FROM orders WHERE o_custkey % 7 = 0),
every AS (SELECT * FROM puts UNION ALL SELECT * FROM late),
newest AS (SELECT row_key, arg_max(o_custkey, version) AS person, arg_max(roi, version) AS roi, max(version) AS version FROM every GROUP BY 1),
dead AS (SELECT row_key, max(version) AS dv FROM gone GROUP BY 1),
seen AS (SELECT newest.row_key, CAST(person AS VARCHAR) AS person, '{DATASET}' AS dataset, '{ATLAS}' AS atlas, roi, version
  FROM newest LEFT JOIN dead USING (row_key) WHERE dv IS NULL OR version > dv)"""


def _compacted(spark, sf_dir):
    """A keyed table put twice and deleted from, compacted, and opened with
    later puts (some of an older version) and tombstones."""
    path, dead, out = _scratch(spark, "keyed"), _scratch(spark, "tombstones"), _scratch(spark, "compacted")
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.concat(F.lit(ROW_KEY_PREFIX), F.col("o_custkey").cast("string"))
    gone = F.concat(F.lit(ROW_KEY_PREFIX), F.col("c_custkey").cast("string")).alias("row_key")

    def rows(df, roi, version):
        return keyed.make_rows(df, key, F.col("o_custkey"), F.lit(DATASET), F.lit(ATLAS), roi, version)
    keyed.put(rows(o, F.col("o_orderpriority"), F.col("o_orderkey")), path)
    keyed.put(rows(o.filter(F.col("o_orderstatus") == "F"), F.col("o_orderstatus"), F.col("o_orderkey") + SECOND_PUT), path)
    keyed.delete(spark, c.filter(F.col("c_acctbal") < 0).select(gone), F.lit(TOMBSTONE), dead)
    compacted.compact(keyed.scan(spark, path), spark.read.schema(keyed.TOMBSTONE_SCHEMA).parquet(dead), out, "first")
    late = rows(o.filter(F.col("o_custkey") % 7 == 0), F.lit("late"),
                F.col("o_orderkey") + F.when(F.col("o_custkey") % 2 == 0, F.lit(THIRD_PUT)).otherwise(F.lit(1)))
    buried = c.filter(F.col("c_custkey") % 11 == 0).select(gone, F.lit(THIRD_PUT).cast("bigint").alias("version"))
    return compacted.Compacted(spark, out, "first", late, buried)


@query("keyed_compacted", _COMPACTED_SQL + " SELECT * FROM seen")
def keyed_compacted(spark, sf_dir):
    """The read view of a compacted table with what was written since."""
    return keyed.flatten(_compacted(spark, sf_dir).latest())


@query("keyed_compacted_lookups", _COMPACTED_SQL + """ SELECT 'get' AS kind, * FROM seen WHERE row_key = 'HCP_42'
UNION ALL SELECT 'multi', * FROM seen WHERE row_key IN ('HCP_1', 'HCP_7', 'HCP_14', 'HCP_22', 'HCP_none')
UNION ALL SELECT 'prefix', * FROM seen WHERE starts_with(row_key, 'HCP_12')""")
def keyed_compacted_lookups(spark, sf_dir):
    """Point get, multi-get and prefix scan that read the ranges which hold them."""
    t = _compacted(spark, sf_dir)
    found = {"get": t.get("HCP_42"), "multi": t.multi_get(["HCP_1", "HCP_7", "HCP_14", "HCP_22", "HCP_none"]),
             "prefix": t.prefix_scan("HCP_12")}
    parts = [keyed.flatten(df).select(F.lit(kind).alias("kind"), "*") for kind, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("keyed_sink", f"""SELECT 'HCP_' || CAST(user_id AS VARCHAR) AS row_key, CAST(user_id + 100000 AS VARCHAR) AS person,
  '{ATLAS}' AS atlas, t, value FROM ({SERIES_SQL})""")
def keyed_sink(spark, sf_dir):
    """Series routed to the keyed table as JSON cells, and read back."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    path = _scratch(spark, "sink")
    rows = s.select("user_id", "t", "value", (F.col("user_id") + 100_000).alias("person"))
    files.route_sink(rows, "base", path, "user_id", person="person")
    view = keyed.latest(keyed.scan(spark, path, files.DATASET, files.ATLAS))
    cells = keyed.flatten(view).select("row_key", "person", "atlas", "roi")
    return from_cells(cells, ["row_key", "person", "atlas"]).select("row_key", "person", "atlas", "t", "value")


@query("stored_formulas", _FIT_SQL + f"""
SELECT formula_id, region, length, {sql_r6('mse', 9)} AS mse FROM m""")
def stored_formulas(spark, sf_dir):
    """Formulas appended to the formula table, read back as text and scored."""
    path = _scratch(spark, "formulas")
    half = len(FORMULAS) // 2
    for part in (list(FORMULAS)[:half], list(FORMULAS)[half:]):
        formula.save_formulas(formula.formula_rows(spark, {i: FORMULAS[i] for i in part}), path)
    # formulas go into the plan as text: as many as were saved, and no more
    stored = spark.read.schema(formula.FORMULA_SCHEMA).parquet(path).limit(len(FORMULAS) + 1).collect()
    if len(stored) > len(FORMULAS):
        raise ValueError("more formulas than were saved")
    formula.register_sql_functions(spark)
    row = table(spark, sf_dir, "lineitem").agg(*[
        F.avg((F.expr(r["expr"]) - F.col(r["region"])) ** 2).alias(str(r["formula_id"])) for r in stored])
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(r["formula_id"]).cast("bigint").alias("formula_id"), F.lit(r["region"]).alias("region"),
        F.lit(r["length"]).cast("int").alias("length"), r6(F.col(str(r["formula_id"])), 9).alias("mse")) for r in stored]))
        .alias("r")).select("r.*")


# ------------------------------------------------------------- the job's status
_GAP = "event_id % 40 <> 0"


@query("extraction_status", f"""WITH r AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
c AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE {_GAP}),
n AS (SELECT r.user_id, count(*) AS n_timepoints, count(*) FILTER (WHERE c.d IS NULL) AS n_gaps FROM r LEFT JOIN c USING (user_id, d) GROUP BY 1)
SELECT c_custkey AS user_id, c_nationkey AS person, coalesce(n_timepoints, 0) AS n_timepoints, coalesce(n_gaps, 0) AS n_gaps,
  CASE WHEN coalesce(n_timepoints, 0) = 0 OR n_gaps > 0 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN coalesce(n_timepoints, 0) = 0 THEN 'no voxel rows' WHEN n_gaps > 0 THEN 'time points without confounds' END AS error
FROM customer LEFT JOIN n ON n.user_id = c_custkey""")
def extraction_status(spark, sf_dir):
    """Status of every scan of the work list (a scan per customer): scans
    without voxel rows and scans with time points that lack confounds."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.datediff(F.to_date("ts"), F.lit("1970-01-01")).alias("t"))
    work = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("person"))
    regions = ev.select("user_id", "t").distinct()
    confounds = ev.filter(_GAP).select("user_id", "t").distinct()
    good, bad = scan_status(work, regions, confounds, "user_id", "t")
    return good.unionByName(bad).select("user_id", "person", "n_timepoints", "n_gaps", "status", "error")


_DAY = "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))"


@query("guarded_fits", f"""WITH s AS (SELECT user_id, event_type, count(*) AS n, count(*) FILTER (WHERE event_id % 97 = 0) AS lost,
  min({_DAY}) AS first_day FROM events GROUP BY 1, 2),
m AS (SELECT user_id, event_type, s.n, s.lost, sum(x)::DOUBLE AS sx, sum(x * x)::DOUBLE AS sxx, sum(y) AS sy, sum(x * y) AS sxy
  FROM (SELECT user_id, event_type, value AS y, ({_DAY} - first_day)::DOUBLE AS x FROM events JOIN s USING (user_id, event_type))
  JOIN s USING (user_id, event_type) GROUP BY ALL),
d AS (SELECT *, n * sxx - sx * sx AS det FROM m)
SELECT user_id, event_type, CASE WHEN lost > 0 OR det = 0 THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN lost > 0 THEN 'ValueError: ' || lost || ' values are missing' WHEN det = 0 THEN 'LinAlgError: Singular matrix' END AS error,
  CASE WHEN lost = 0 AND det <> 0 THEN {sql_r6("(n * sxy - sx * sy) / det", 4)} END AS slope,
  CASE WHEN lost = 0 AND det <> 0 THEN {sql_r6("(sxx * sy - sx * sxy) / det", 4)} END AS intercept FROM d""")
def guarded_fits(spark, sf_dir):
    """A line through the values of every (user, event type), from sums added
    up natively; scans with missing values or a single day raise inside their
    fit and appear as error rows, all others are fitted."""
    ev = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.datediff(F.to_date("ts"), F.lit("1970-01-01")).alias("day"), "value",
        (F.col("event_id") % 97 == 0).cast("int").alias("lost"))
    keys = ["user_id", "event_type"]
    first = broadcast_if_small(ev.groupBy(*keys).agg(F.min("day").alias("first_day")))
    x = (F.col("day") - F.col("first_day")).cast("double")
    sums = ev.join(first, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("lost").alias("lost"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"),
        F.sum("value").alias("sy"), F.sum(x * F.col("value")).alias("sxy"))

    def line(r):
        if r["lost"]:
            raise ValueError(f"{r['lost']} values are missing")
        b = np.linalg.solve([[r["n"], r["sx"]], [r["sx"], r["sxx"]]], [r["sy"], r["sxy"]])
        return {"intercept": float(b[0]), "slope": float(b[1])}
    fits, status = guarded_rows(sums, keys, line, "intercept double, slope double")
    return status.join(fits, keys, "left").select(*keys, "status", "error", r6(F.col("slope"), 4).alias("slope"),
                                                  r6(F.col("intercept"), 4).alias("intercept"))


# ------------------------------------------------------------- rows and functions
@query("positional_zip", """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r <= 2""")
def positional_zip(spark, sf_dir):
    """The first two archives of every person (a truncating zip)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return first_n_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"], 2).select("o_custkey", "o_orderkey")


@query("columns_as_rows", f"""SELECT l_orderkey, l_linenumber, region, value FROM (
  SELECT l_orderkey, l_linenumber, {", ".join(REGION_COLS)} FROM lineitem) UNPIVOT (value FOR region IN ({", ".join(REGION_COLS)}))""")
def columns_as_rows(spark, sf_dir):
    return to_long(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], REGION_COLS)


@query("whole_table", "SELECT * FROM customer")
def whole_table(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("*")


@query("activations", f"""SELECT l_orderkey, l_linenumber,
  {sql_r6('CASE WHEN z > 20 THEN z ELSE ln(1 + exp(z)) END', 9)} AS soft, {sql_r6('tanh(z)', 9)} AS tanh
FROM (SELECT *, l_quantity - 25.0 AS z FROM lineitem)""")
def activations(spark, sf_dir):
    z = F.col("l_quantity") - 25.0
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r6(softplus(z), 9).alias("soft"),
                                                   r6(F.tanh(z), 9).alias("tanh"))


@query("seeded_constants", f"""SELECT o_orderkey,
  round_even({sql_draw(3, 'o_orderkey')} / CAST({1 << DRAW_BITS} AS DOUBLE) * 4.0 + -2.0, 2) + 0.0 AS c,
  {sql_draw(4, 'o_orderkey')} % 5 + 6 AS depth FROM orders""")
def seeded_constants(spark, sf_dir):
    """A random constant in [-2, 2) and a random depth in 6..10 per row."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", (uniform_constant(3, F.col("o_orderkey")) + F.lit(0.0)).alias("c"),
                    random_int(4, F.col("o_orderkey"), low=6, high=10).alias("depth"))

"""Table queries: joins, routing, work-lists, keyed table, JSON, paths,
region means, as-of join, positions and names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxelframe.functions import json_cells, paths
from voxelframe.functions.numeric import r6, sql_r6
from voxelframe.functions.regions import first_missing, pairwise_products
from voxelframe.operators.aggregates import distinct_sorted_int, region_means
from voxelframe.operators.asof import asof_cogroup, asof_join
from voxelframe.operators.joins import expand_worklist, label_lookup, route, skip_done
from voxelframe.operators.ordinal import add_ordinal, numeric_split, prefix_sum
from voxelframe.plans.registry import query
from voxelframe.plans.stand_ins import (ATLAS, DATASET, MEN_SEGMENT, REGION_COLS, ROW_KEY_PREFIX,
                                        SERIES_SQL, series)
from voxelframe.sources import keyed
from voxelframe.tables import table

# ------------------------------------------------------------- routing
@query("cohort_route", f"""
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN c_mktsegment = '{MEN_SEGMENT}' THEN 'men' ELSE 'women' END AS cohort
FROM orders JOIN customer ON c_custkey = o_custkey""")
def cohort_route(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = label_lookup(o, c, "o_custkey")
    # both cohorts in one frame, told apart by a column: the concatenation
    # of the two routed lists without reading the input twice
    return j.withColumn("cohort", route(F.col("c_mktsegment"), MEN_SEGMENT, "men", "women")) \
            .drop("c_mktsegment")


@query("unmatched_labels", """
SELECT DISTINCT l.doc_id FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL
SELECT DISTINCT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unmatched_labels(spark, sf_dir):
    """Report for strict label lookup: documents without a label and labels
    without a document."""
    from voxelframe.operators.joins import unmatched
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id")
    return unmatched(lab, d, "doc_id").unionByName(unmatched(d, lab, "doc_id"))


@query("concat_by_name", """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL BY NAME
  SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_returnflag <> 'R')""")
def concat_by_name(spark, sf_dir):
    """Concatenate per-scan frames whose columns differ: matched by name,
    missing columns are null."""
    li = table(spark, sf_dir, "lineitem")
    a = li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity")
    b = li.filter(F.col("l_returnflag") != "R").select("l_orderkey", "l_linenumber", "l_discount")
    return a.unionByName(b, allowMissingColumns=True)


# ------------------------------------------------------------- work-lists
_DONE_SQL = """
SELECT DISTINCT o_custkey AS person,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS session,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'LR' ELSE 'RL' END AS direction
FROM orders"""


@query("worklist_cross_anti", f"""
WITH p AS (SELECT DISTINCT CAST(c_custkey AS BIGINT) AS person FROM customer),
w AS (SELECT person, s.session, d.direction FROM p, (VALUES (1), (2)) s(session), (VALUES ('LR'), ('RL')) d(direction)),
done AS ({_DONE_SQL})
SELECT person, session, direction FROM w
WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.person = w.person AND done.session = w.session AND done.direction = w.direction)""")
def worklist_cross_anti(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("person")).distinct()
    work = expand_worklist(people, [1, 2], ["LR", "RL"])
    o = table(spark, sf_dir, "orders")
    done = o.select(
        F.col("o_custkey").alias("person"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("session"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "LR").otherwise("RL").alias("direction"))
    return skip_done(work, done, ["person", "session", "direction"])


@query("people_sorted", "SELECT DISTINCT CAST(o_custkey AS BIGINT) AS person FROM orders ORDER BY 1")
def people_sorted(spark, sf_dir):
    return distinct_sorted_int(table(spark, sf_dir, "orders"), "o_custkey", "person")


@query("group_first", """
SELECT o_custkey, min(o_orderkey) AS first_order, arg_min(o_orderstatus, o_orderkey) AS first_status
FROM orders GROUP BY o_custkey""")
def group_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"),
                                      F.min_by("o_orderstatus", "o_orderkey").alias("first_status"))


@query("first_row", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1""")
def first_row(spark, sf_dir):
    """First result row of a sorted summary (a top-1: the limit is the feature)."""
    return (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
            .orderBy("o_orderdate", "o_orderkey").limit(1))


# ------------------------------------------------------------- keyed table
_KEYED_SQL = f"""
WITH k AS (SELECT '{ROW_KEY_PREFIX}' || CAST(o_custkey AS VARCHAR) AS row_key,
                  CAST(o_custkey AS VARCHAR) AS person, '{DATASET}' AS dataset, '{ATLAS}' AS atlas,
                  o_orderpriority AS roi, o_orderkey AS version FROM orders),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY version DESC) AS rn FROM k) WHERE rn = 1)
"""
_KEYED_COLS = "row_key, person, dataset, atlas, roi, version"
TOMBSTONE_VERSION = 10_000


def _keyed_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return keyed.make_rows(o, paths.row_key(F.col("o_custkey"), ROW_KEY_PREFIX), F.col("o_custkey"),
                           F.lit(DATASET), F.lit(ATLAS), F.col("o_orderpriority"), F.col("o_orderkey"))


def _view(spark, sf_dir, tombstones=None):
    return keyed.flatten(keyed.latest(_keyed_rows(spark, sf_dir), tombstones))


@query("keyed_latest", _KEYED_SQL + f"SELECT {_KEYED_COLS} FROM latest")
def keyed_latest(spark, sf_dir):
    return _view(spark, sf_dir)


@query("keyed_prefix", _KEYED_SQL + f"SELECT {_KEYED_COLS} FROM latest WHERE starts_with(row_key, 'HCP_12')")
def keyed_prefix(spark, sf_dir):
    return keyed.prefix_scan(_view(spark, sf_dir), "HCP_12")


@query("keyed_point_get", _KEYED_SQL + f"SELECT {_KEYED_COLS} FROM latest WHERE row_key = 'HCP_42'")
def keyed_point_get(spark, sf_dir):
    return keyed.get(_view(spark, sf_dir), "HCP_42")


@query("keyed_multi_get", _KEYED_SQL + f"""
SELECT {_KEYED_COLS} FROM latest WHERE row_key IN ('HCP_1', 'HCP_10', 'HCP_100', 'HCP_1000', 'HCP_none')""")
def keyed_multi_get(spark, sf_dir):
    return keyed.multi_get(_view(spark, sf_dir), ["HCP_1", "HCP_10", "HCP_100", "HCP_1000", "HCP_none"])


@query("keyed_multi_get_table", _KEYED_SQL + f"""
SELECT {_KEYED_COLS} FROM latest WHERE row_key IN (SELECT '{ROW_KEY_PREFIX}' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'FURNITURE')""")
def keyed_multi_get_table(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "FURNITURE") \
        .select(paths.row_key(F.col("c_custkey")).alias("row_key"))
    return keyed.multi_get(_view(spark, sf_dir), keys)


@query("keyed_delete", _KEYED_SQL + f"""
, tomb AS (SELECT '{ROW_KEY_PREFIX}' || CAST(c_custkey AS VARCHAR) AS row_key, max({TOMBSTONE_VERSION}) AS v
           FROM customer WHERE c_acctbal < 0 GROUP BY 1)
SELECT {_KEYED_COLS} FROM latest LEFT JOIN tomb USING (row_key) WHERE tomb.v IS NULL OR latest.version > tomb.v""")
def keyed_delete(spark, sf_dir):
    """Keys of customers with a negative balance are deleted at version
    10000; a later put (order key above 10000) brings the key back."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    tomb = c.select(paths.row_key(F.col("c_custkey")).alias("row_key"),
                    F.lit(TOMBSTONE_VERSION).cast("bigint").alias("version"))
    return _view(spark, sf_dir, tomb)


# ------------------------------------------------------------- JSON
@query("json_roundtrip", f"WITH o AS ({SERIES_SQL}) SELECT user_id, 'value' AS \"column\", t, value FROM o")
def json_roundtrip(spark, sf_dir):
    """Series -> JSON cells (column -> time -> value) -> rows again."""
    s = series(spark, sf_dir, cols=("event_id", "ts", "user_id", "value"))
    cells = json_cells.to_cells(s, ["user_id"], "t", ["value"])
    return json_cells.from_cells(cells, ["user_id"]).select("user_id", "column", "t", "value")


@query("props_parse", """
SELECT event_id, k AS key, CAST(json_extract(props, '$."' || k || '"') AS BIGINT) AS val
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def props_parse(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return ev.select("event_id", F.explode(json_cells.parse_map(F.col("props"))).alias("key", "val"))


# ------------------------------------------------------------- paths
@query("path_parts", """
SELECT page_id,
  string_split(url, '/')[-1] AS file,
  string_split(string_split(url, '/')[3], '.')[1] AS host_stem,
  string_split(url, '/')[4] AS lang,
  TRY_CAST(string_split(string_split(string_split(url, '/')[-1], '?')[1], '_')[1] AS BIGINT) AS number,
  (starts_with(url, 'https://') OR starts_with(url, 'http://m.')) AS preferred,
  format('{}/{}', string_split(url, '/')[4], string_split(string_split(url, '/')[-1], '?')[1]) AS short_path,
  'HCP_' || string_split(string_split(url, '/')[3], '.')[1] AS row_key,
  CAST(octet_length(encode(url)) AS INTEGER) AS n_bytes,
  CAST(length(url) AS INTEGER) AS n_chars
FROM pages""")
def path_parts(spark, sf_dir):
    u = F.col("url")
    file = paths.last_part(u)
    host = paths.part(u, "/", 3)
    lang = paths.part(u, "/", 4)
    stem = paths.part(file, r"\?", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        file.alias("file"),
        paths.strip_extension(host).alias("host_stem"),
        lang.alias("lang"),
        paths.int_part(stem, "_", 1).alias("number"),
        paths.starts_with_any(u, "https://", "http://m.").alias("preferred"),
        F.format_string("%s/%s", lang, stem).alias("short_path"),
        paths.row_key(paths.strip_extension(host)).alias("row_key"),
        F.octet_length(F.encode(u, "UTF-8")).alias("n_bytes"),
        F.length(u).alias("n_chars"))


@query("missing_region", """
WITH r AS (SELECT DISTINCT l_orderkey, CAST(substr('x' || CAST(l_linenumber - 1 AS VARCHAR), 2) AS INTEGER) AS num FROM lineitem),
c AS (SELECT l_orderkey, 0 AS num FROM r UNION SELECT l_orderkey, num + 1 FROM r)
SELECT l_orderkey, CAST(min(num) AS INTEGER) AS missing FROM c
WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.l_orderkey = c.l_orderkey AND r.num = c.num)
GROUP BY l_orderkey""")
def missing_region(spark, sf_dir):
    """Each order's lines are regions x0, x1, ... (line number - 1); report
    the first region number that is absent."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", paths.region_name(F.col("l_linenumber") - 1).alias("region"))
    nums = li.select("l_orderkey", paths.region_number(F.col("region")).alias("num"))
    return first_missing(nums, ["l_orderkey"], "num")


@query("poly_features", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{a} * {b} AS {a}_x_{b}" for i, a in enumerate(REGION_COLS) for b in REGION_COLS[i:]) + " FROM lineitem")
def poly_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *pairwise_products(REGION_COLS))


# ------------------------------------------------------------- region means
EVENT_TYPES_SQL = "SELECT DISTINCT event_type FROM events ORDER BY 1"


def region_mean_pivot_sql(types):
    cols = ", ".join(f"{sql_r6(f'avg(value) FILTER (WHERE event_type = {chr(39)}{t}{chr(39)})')} AS x{i}"
                     for i, t in enumerate(types))
    return (f"SELECT user_id, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS t, "
            f"{cols} FROM events GROUP BY 1, 2")


@query("region_mean_pivot", region_mean_pivot_sql(["click", "error", "purchase", "signup", "view"]))
def region_mean_pivot(spark, sf_dir):
    """Voxel rows (scan = user, voxel = event, t = day) joined to the
    broadcast label table, averaged per region into x0..x{n-1}."""
    from voxelframe.operators.aggregates import distinct_values, label_table
    ev = table(spark, sf_dir, "events")
    types = distinct_values(ev, "event_type")          # bounded label list
    atlas = label_table(spark, types, "event_type")
    labels = list(range(1, len(types) + 1))
    vox = ev.select("user_id", "event_type", "value",
                    F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("t"))
    wide = region_means(vox, atlas, ["user_id", "t"], "label", "value", labels)
    return wide.select("user_id", "t", *[r6(F.col(f"x{i}")).alias(f"x{i}") for i in range(len(labels))])


# ------------------------------------------------------------- as-of
_ASOF_SQL = """
SELECT p.event_id, p.user_id, p.ts, p.value, c.ts AS click_ts, c.event_id AS click_event_id, c.value AS click_value
FROM (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click') c
ON p.user_id = c.user_id AND p.ts >= c.ts"""


def _asof_sides(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    left = ev.filter(F.col("event_type") == "purchase").drop("event_type")
    right = ev.filter(F.col("event_type") == "click").drop("event_type")
    return left, right


@query("asof_last_event", _ASOF_SQL)
def asof_last_event(spark, sf_dir):
    """Each purchase with the user's latest click at or before it."""
    left, right = _asof_sides(spark, sf_dir)
    return asof_join(left, right, ["user_id"], "ts", bucket="auto", right_prefix="click_")


_ASOF_TIES_SQL = """
WITH l AS (SELECT event_id, user_id, CASE WHEN event_id % 11 <> 0 THEN date_trunc('day', ts) END AS day FROM events
    WHERE event_type = 'purchase'),
r AS (SELECT user_id, day, last(event_id ORDER BY value, event_id) AS view_id, last(value ORDER BY value, event_id) AS value
  FROM (SELECT event_id, user_id % 7 AS user_id, value, CASE WHEN event_id % 13 <> 0 THEN date_trunc('day', ts) END AS day
        FROM events WHERE event_type = 'view') WHERE day IS NOT NULL GROUP BY user_id, day)
SELECT l.event_id, l.user_id % 7 AS user_id, l.day, r.day AS view_day, r.view_id AS view_event_id, r.value AS view_value
FROM l ASOF LEFT JOIN r ON l.user_id % 7 = r.user_id AND l.day >= r.day"""


def _tied_sides(spark, sf_dir):
    """Users in seven groups and times in whole days, some unknown, so that
    many right rows share a group and a time."""
    ev = table(spark, sf_dir, "events")

    def side(kind, every):
        day = F.when(F.col("event_id") % every != 0, F.date_trunc("day", "ts").cast("timestamp_ntz"))
        return ev.filter(F.col("event_type") == kind).select("event_id", (F.col("user_id") % 7).alias("user_id"),
                                                             day.alias("day"), "value")
    return side("purchase", 11).drop("value"), side("view", 13)


@query("asof_ties", _ASOF_TIES_SQL)
def asof_ties(spark, sf_dir):
    """Latest view at or before each purchase where many views share a time:
    of those the one with the largest value, then id."""
    left, right = _tied_sides(spark, sf_dir)
    return asof_join(left, right, ["user_id"], "day", bucket="auto", right_prefix="view_", tie_break=["value", "event_id"])


@query("asof_ties_cogroup", _ASOF_TIES_SQL)
def asof_ties_cogroup(spark, sf_dir):
    """The same through the cogrouped form."""
    left, right = _tied_sides(spark, sf_dir)
    right = right.select("user_id", "day", F.col("event_id").alias("view_event_id"), F.col("value").alias("view_value"),
                         F.col("day").alias("view_day"))
    schema = ("event_id long, user_id long, day timestamp_ntz, view_event_id long, view_value double, view_day timestamp_ntz")
    return asof_cogroup(left, right, ["user_id"], "day", schema, bucket="auto", tie_break=["view_value", "view_event_id"])


# ------------------------------------------------------------- positions, names
@query("row_by_position", """
WITH c AS (SELECT c_name, row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS pos FROM customer)
SELECT o_orderkey, c.pos, c_name FROM orders JOIN c ON c.pos = orders.o_custkey""")
def row_by_position(spark, sf_dir):
    """Row at a 0-based position of the work-list (ordered by nation, key);
    each order names the position it wants."""
    c = table(spark, sf_dir, "customer").select("c_name", "c_nationkey", "c_custkey")
    # numbered per (nation, key range): the ranges grow in number with the table
    numbered = add_ordinal(c, [], ["c_nationkey", "c_custkey"], "pos",
                           split_by=F.struct("c_nationkey", numeric_split("c_custkey", 65_536)))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("pos"))
    return o.join(numbered.select("pos", "c_name"), "pos").select("o_orderkey", "pos", "c_name")


@query("name_counter", """
WITH a AS (SELECT l_orderkey, count(*) AS m FROM lineitem GROUP BY 1),
a2 AS (SELECT o_custkey, a.l_orderkey, coalesce(sum(m + 1) OVER (PARTITION BY o_custkey ORDER BY a.l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
       FROM a JOIN orders ON o_orderkey = a.l_orderkey),
m AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM lineitem)
SELECT m.l_orderkey, m.l_linenumber, CAST(o_custkey AS VARCHAR) || '_' || CAST(base + k AS VARCHAR) || '.csv' AS name
FROM m JOIN a2 USING (l_orderkey)""")
def name_counter(spark, sf_dir):
    """Output names numbered per person the way the extraction loop counts:
    the counter rises once per archive and once per member, so for archives
    of 2 members the names are 1, 2, 4, 5, ...  (archive = order,
    member = line)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    per_archive = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("m")).join(o, "l_orderkey")
    base = prefix_sum(per_archive, ["o_custkey"], "l_orderkey", F.col("m") + 1, "base")
    members = li.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")))
    j = members.join(base.select("l_orderkey", "o_custkey", "base"), "l_orderkey")
    return j.select("l_orderkey", "l_linenumber",
                    F.concat(F.col("o_custkey").cast("string"), F.lit("_"),
                             (F.col("base") + F.col("k")).cast("string"), F.lit(".csv")).alias("name"))

"""How the driver's tables stand in for the region data model.

scan       = events.user_id
time t     = 0-based position by (ts, event_id) inside the scan
signal     = events.value
label      = events.event_type
person     = customer.c_custkey, its label = c_mktsegment ('BUILDING' -> men)
region matrix (wide) = lineitem's four numeric columns / embeddings vectors
keyed rows = orders with row key 'HCP_' || o_custkey, version o_orderkey
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxelframe.operators.ordinal import add_time_ordinal
from voxelframe.tables import table

# Fixed values of the stand-in mapping.
MEN_SEGMENT = "BUILDING"
ROW_KEY_PREFIX = "HCP_"
DATASET = "HCP"
ATLAS = "harvard_oxford"
REGION_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# SQL twin of ``series``: same ordinal rule
SERIES_SQL = ("SELECT event_id, ts, user_id, event_type, value, props, "
              "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t FROM events")


def series(spark: SparkSession, sf_dir: str, cols=("event_id", "ts", "user_id", "event_type", "value")) -> DataFrame:
    """events as region series with the ordinal ``t``.

    Numbering runs on sampled ranges of (user, time, id)
    (``add_time_ordinal``), so one very long series is numbered by many
    tasks, and the numbered rows are written once.
    """
    ev = table(spark, sf_dir, "events").select(*cols)
    return add_time_ordinal(ev, ["user_id"], "ts", ["event_id"], "t")

"""Region tables as JSON cells (column -> time index -> value) and back.

A cell holds at most ``cell_rows`` time points of one scan, so no cell --
and no task building it -- grows with the length of a series.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_ROWS = 10_000
CELL_SCHEMA = "map<string,map<string,double>>"


def to_cells(df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str],
             cell_rows: int = CELL_ROWS, name: str = "roi") -> DataFrame:
    """One JSON text per (keys, chunk of ``cell_rows`` time points):
    ``{"col": {"<t>": value, ...}, ...}`` with time keys in numeric order."""
    d = df.withColumn("chunk", F.floor(F.col(t) / F.lit(cell_rows)).cast("bigint"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(t).alias("t"),
                                                    *[F.col(c).alias(c) for c in cols])))
    g = d.groupBy(*keys, "chunk").agg(entries.alias("_e"))
    def entry_of(c):
        return lambda e: F.struct(e["t"].cast("string").alias("k"), e[c].alias("v"))

    per_col = [F.struct(F.lit(c).alias("k"),
                        F.map_from_entries(F.transform(F.col("_e"), entry_of(c))).alias("v"))
               for c in cols]
    return g.select(*keys, "chunk", F.to_json(F.map_from_entries(F.array(*per_col))).alias(name))


def from_cells(cells: DataFrame, keys: Sequence[str], name: str = "roi",
               t: str = "t") -> DataFrame:
    """Explode JSON cells back to long rows (keys, column, t, value)."""
    m = cells.select(*keys, F.from_json(F.col(name), CELL_SCHEMA).alias("_m"))
    a = m.select(*keys, F.explode("_m").alias("column", "_inner"))
    return a.select(*keys, "column", F.explode("_inner").alias("_t", "value")) \
            .withColumn(t, F.col("_t").cast("bigint")).drop("_t")


def parse_map(c, value_type: str = "bigint"):
    """JSON object text -> map<string, value_type>."""
    return F.from_json(c, f"map<string,{value_type}>")

"""Region-name operators: first missing region, polynomial features."""

from __future__ import annotations

from itertools import combinations_with_replacement
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_missing(df: DataFrame, keys: Sequence[str], num: str, name: str = "missing") -> DataFrame:
    """Smallest non-negative number absent from ``num`` within each key.

    The distinct numbers of a key, sorted, equal their rank until the first
    gap; the gap is the first rank that differs (or the count when there is
    none).  One window per key over its distinct numbers (bounded by the
    number of regions, not by the data).
    """
    present = df.select(*keys, F.col(num).alias("_n")).filter(F.col("_n") >= 0).distinct()
    w = Window.partitionBy(*keys).orderBy("_n")
    ranked = present.withColumn("_r", (F.row_number().over(w) - 1).cast(present.schema["_n"].dataType))
    return ranked.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(F.col("_n") != F.col("_r"), F.col("_r"))),
                   F.count(F.lit(1)).cast(present.schema["_n"].dataType)).alias(name))


def to_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "region",
            value: str = "value") -> DataFrame:
    """Wide region table -> (keys, region, value): the column list as data."""
    return df.unpivot(list(keys), list(cols), name, value)


def pairwise_products(cols: Sequence[str], squares: bool = True, sep: str = "_x_") -> list[Column]:
    """x*y for every pair (and x*x when ``squares``), named ``x_x_y``."""
    pairs = combinations_with_replacement(cols, 2) if squares else \
        ((a, b) for i, a in enumerate(cols) for b in cols[i + 1:])
    return [(F.col(a) * F.col(b)).alias(f"{a}{sep}{b}") for a, b in pairs]

"""Path and name helpers (all JVM-side string functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(c: Column, sep_regex: str, i: int) -> Column:
    """The i-th (1-based, negative from the end) piece of ``c`` split on a
    regex; null when there is no such piece."""
    return F.try_element_at(F.split(c, sep_regex), F.lit(i))


def last_part(c: Column, sep: str = "/") -> Column:
    return part(c, sep, -1)


def strip_extension(c: Column) -> Column:
    """Everything before the first dot."""
    return part(c, r"\.", 1)


def int_part(c: Column, sep: str = "_", i: int = 1) -> Column:
    """i-th piece cast to bigint; null when not a number."""
    return part(c, sep, i).try_cast("bigint")


def starts_with_any(c: Column, *prefixes: str) -> Column:
    cond = None
    for p in prefixes:
        e = c.startswith(p)
        cond = e if cond is None else (cond | e)
    return cond


def row_key(c: Column, prefix: str = "HCP_") -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def region_number(name: Column) -> Column:
    """'x12' -> 12."""
    return F.substring(name, 2, 1 << 20).try_cast("int")


def region_name(i: Column) -> Column:
    """12 -> 'x12' (positional naming)."""
    return F.concat(F.lit("x"), i.cast("string"))

"""Lookup joins, routing, work-list expansion and skip-done anti joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Budget for one broadcast side.  The row bound is derived from it and an
# estimate of the row width; the check counts at most ``max_rows + 1`` rows,
# so it costs little even on a large input.
BROADCAST_MAX_BYTES = 64 << 20
BROADCAST_MAX_ROWS = 2_000_000

_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
          "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def row_bytes(df: DataFrame) -> int:
    """Width of a row as far as the types tell; see ``measured_bytes``."""
    return 16 + sum(_WIDTH.get(t, 32) for _, t in df.dtypes)


def measured_bytes(df: DataFrame) -> Column:
    """Total in-memory bytes of the rows as an aggregate: fixed widths from
    the types, strings and nested values by their own length."""
    size = F.lit(row_bytes(df.select(*[c for c, t in df.dtypes if t in _WIDTH])))
    for c, t in df.dtypes:
        if t in _WIDTH:
            continue
        text = F.col(c) if t in ("string", "binary") else F.to_json(F.struct(F.col(c)))
        # a JSON digit is at least half a byte of a number
        size = size + F.lit(16) + 2 * F.coalesce(F.octet_length(text), F.lit(0))
    return F.coalesce(F.sum(size), F.lit(0))


def _fits(df: DataFrame, max_rows: int | None) -> bool:
    """Whether at most ``max_rows`` rows (default: what the types allow) make
    up at most ``BROADCAST_MAX_BYTES``; counts no more rows than that."""
    bound = max_rows or max_broadcast_rows(df)
    few = df.limit(bound + 1)
    if all(t in _WIDTH for _, t in df.dtypes):
        return few.count() <= bound
    n, size = few.agg(F.count(F.lit(1)), measured_bytes(few)).first()
    return n <= bound and size <= BROADCAST_MAX_BYTES


def max_broadcast_rows(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> int:
    return max(1, min(BROADCAST_MAX_ROWS, max_bytes // row_bytes(df)))


def sized_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only after proving the side is small: at most
    ``max_rows`` rows and ``BROADCAST_MAX_BYTES`` measured bytes.

    Beyond the bound the plain frame is returned: Spark then plans a
    shuffle join, and AQE can still switch to broadcast from measured sizes
    or split skewed partitions.
    """
    return F.broadcast(df) if _fits(df, max_rows) else df


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """For a derived table (e.g. one row of statistics per series): compute
    it once into the shared checkpoint folder (``session.materialize``),
    prove its size, broadcast it when small.  The join then reads the
    checkpoint, never the source again."""
    from voxelframe.session import materialize
    d = materialize(df)
    return F.broadcast(d) if _fits(d, max_rows) else d


def label_lookup(df: DataFrame, labels: DataFrame, on: str | Sequence[str],
                 strict: bool = False, max_rows: int | None = None) -> DataFrame:
    """Equi-join each row to its single label row (person -> gender).

    Rows whose key has no label are dropped (inner join).  ``strict=True``
    raises when any key is unmatched, the behaviour of a positional lookup
    that finds nothing.
    """
    lab = sized_broadcast(labels, max_rows)
    if strict:
        missing = unmatched(df, labels, on).limit(1).count()
        if missing:
            raise KeyError("rows without a label; see unmatched()")
    return df.join(lab, on, "inner")


def unmatched(df: DataFrame, labels: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` that have no label (report for strict mode)."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.select(*keys).distinct().join(labels.select(*keys), keys, "left_anti")


def route(c: Column, when_value, then_name: str, else_name: str) -> Column:
    """Two-way routing: ``then_name`` where ``c == when_value``, every other
    value (including null) goes to ``else_name``."""
    return F.when(c == F.lit(when_value), F.lit(then_name)).otherwise(F.lit(else_name))


def expand_worklist(people: DataFrame, sessions: Sequence[int], directions: Sequence[str],
                    session_col: str = "session", direction_col: str = "direction") -> DataFrame:
    """Person x session x direction work-list.

    The fixed session/direction lists are a literal array exploded per row:
    a bounded fan-out (len(sessions) * len(directions)) with no join.
    """
    combos = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(d).alias("d"))
                       for s in sessions for d in directions])
    return (people.withColumn("_c", F.explode(combos))
                  .withColumn(session_col, F.col("_c.s"))
                  .withColumn(direction_col, F.col("_c.d"))
                  .drop("_c"))


def skip_done(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work items whose keys are not in ``done`` (skip outputs that exist)."""
    return work.join(done.select(*keys).distinct(), list(keys), "left_anti")


def align_on_time(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("scan_id", "t")) -> DataFrame:
    """Attach per-time-point rows (confounds) to a region table.  Every
    region row stays: a time point without a confound row has null
    confounds, and so a null residual, which ``time_gaps`` counts."""
    return left.join(right, list(keys), "left")


def time_gaps(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("scan_id", "t")) -> DataFrame:
    """Per scan (all keys but the last): time points without a row in ``right``."""
    scan = list(keys)[:-1]
    return (left.join(right.select(*keys).distinct(), list(keys), "left_anti")
                .groupBy(*scan).agg(F.count(F.lit(1)).alias("missing")))


def first_n_per_key(df: DataFrame, key: str, order: Sequence[str], n: int | None) -> DataFrame:
    """Keep the first ``n`` rows per key in ``order`` (the truncating
    positional zip of the original work loop); ``None`` keeps all rows."""
    if n is None:
        return df
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")

"""Failure boundary per scan: a function that raises for one scan gives that
scan an error row, and the others go on.

``guarded_rows`` is for work on a scan's statistics: they are aggregated
natively before, one row a scan, so a hot scan costs no more than others.
``guarded_groups`` is for functions that need a scan's rows together, in one
frame; a scan of more than ``max_rows`` rows is never gathered and becomes an
error row itself.

Both compute once, into a written table, and return (results, status): the
result rows of the scans that succeeded, and one row for every scan with
status ('ok', 'error') and the error's kind and text.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.session import materialize

STATUS, ERROR = "status", "error"
MAX_ROWS = 1_000_000
# error texts are kept to this length
MAX_TEXT = 1000


def describe(e: BaseException) -> str:
    return f"{type(e).__name__}: {e}"[:MAX_TEXT]


def _nullable(df: DataFrame, keys: Sequence[str], schema: str):
    """Key columns, result columns and the error text as one schema text."""
    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    # a marker tells a result row from the row that only says that a scan was done
    return ", ".join([*kinds, schema, "_row boolean", f"{ERROR} string"])


def _split(done: DataFrame, keys: Sequence[str], names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    done = materialize(done)
    status = done.filter(~F.col("_row")).select(
        *keys, F.when(F.col(ERROR).isNull(), "ok").otherwise("error").alias(STATUS), ERROR)
    return done.filter("_row").select(*keys, *names), status


def _outcome(call: Callable[[], pd.DataFrame], key: tuple, keys: Sequence[str], names: Sequence[str]) -> pd.DataFrame:
    """A scan's result rows followed by its status row, or that row alone."""
    error, rows = None, None
    try:
        rows = call()
        rows = rows[list(names)]
    except Exception as e:  # noqa: BLE001 - any failure of a scan is that scan's status
        error, rows = describe(e), None
    mark = pd.DataFrame([{**dict(zip(keys, key)), **dict.fromkeys(names), "_row": False, ERROR: error}])
    if rows is None or not len(rows):
        return mark
    rows = rows.assign(**dict(zip(keys, key)), _row=True, **{ERROR: None})
    whole = pd.concat([rows.astype(object), mark.astype(object)], ignore_index=True)
    return whole[[*keys, *names, "_row", ERROR]]


def _names(schema: str) -> list[str]:
    from pyspark.sql.types import StructType
    return StructType.fromDDL(schema).names


def guarded_rows(stats: DataFrame, keys: Sequence[str], fn: Callable[[dict], Iterable[dict] | dict], schema: str):
    """``fn(row)`` of every scan's statistics row (a dict) gives its result
    rows, dicts with the columns of ``schema``."""
    keys, names = list(keys), _names(schema)

    def run(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                def call(row=row):
                    found = fn(row)
                    return pd.DataFrame([found] if isinstance(found, dict) else list(found), columns=names)
                out.append(_outcome(call, tuple(row[k] for k in keys), keys, names))
            if out:
                yield pd.concat([o.astype(object) for o in out], ignore_index=True)
    return _split(stats.mapInPandas(run, _nullable(stats, keys, schema)), keys, names)


def guarded_groups(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                   order_by: Sequence[str] = (), max_rows: int = MAX_ROWS):
    """``fn(frame)`` of every scan's rows, in the order of ``order_by``, gives
    its result frame with the columns of ``schema``."""
    from voxelframe.operators.joins import broadcast_if_small
    keys, names, order = list(keys), _names(schema), list(order_by)
    sizes = broadcast_if_small(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    many = sizes.filter(F.col("_n") > max_rows)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key = tuple(pdf[k].iloc[0] for k in keys)
        return _outcome(lambda: fn(pdf.sort_values(order, ignore_index=True) if order else pdf), key, keys, names)
    # keys are compared null-safe, so that a scan without a name is a scan too
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    small = df.alias("d").join(F.broadcast(many).alias("m") if many.count() <= 10_000 else many.alias("m"), same, "left_anti")
    done = small.groupBy(*keys).applyInPandas(run, _nullable(df, keys, schema))
    refused = many.select(*keys, *[F.lit(None).cast(f.dataType).alias(f.name) for f in done.schema if f.name in names],
                          F.lit(False).alias("_row"),
                          F.format_string("ValueError: a scan of %d rows, more than %d", F.col("_n"), F.lit(max_rows)).alias(ERROR))
    return _split(done.unionAll(refused), keys, names)

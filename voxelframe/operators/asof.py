"""Backward as-of join: each left row gets the latest right row of the same
key whose time is <= the left row's time (left outer: no match -> nulls).

Spark has no native as-of join.  A single window over left-union-right
partitioned by the key would put one hot key in one task, so the time axis
is cut into buckets:

1. inside a bucket: union both sides and carry the last right row forward
   with ``last(..., ignorenulls)`` over a window on (key, bucket);
2. across buckets: the last right row of every (key, bucket) is a small
   partial-aggregated table; a window over it (one row per key and bucket)
   gives, for every bucket that has left rows, the last right row of any
   *earlier* bucket;
3. result = in-bucket match, else the carried match.

Exact for any bucket width; the width only decides how work is spread.  Of
right rows with equal key and time the one that is last by ``tie_break`` counts
(columns in ascending order, nulls first), of equal ones the one with the
largest hash of its row, so every bucketing gives the same answer.  Rows with a
null time or key match nothing: such left rows stay, unmatched.
A cogrouped pandas form over the same (key, bucket) groups is provided for
the grouped-map API (``asof_cogroup``).
"""

from __future__ import annotations

from typing import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(on: str, bucket: Callable[[Column], Column] | None) -> Column:
    return bucket(F.col(on)) if bucket is not None else F.lit(0)


RANGES_PER_TASK = 4


TIE = "_tie"


def _with_tie(right: DataFrame, by: Sequence[str], on: str, tie_break: Sequence[str]) -> DataFrame:
    """Right rows that can match, with ``TIE``: a struct that orders rows of
    equal key and time."""
    hashed = [f.name for f in right.schema.fields if "map<" not in f.dataType.simpleString()]
    known = F.col(on).isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    return right.filter(known).withColumn(
        TIE, F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_break)], F.xxhash64(*hashed).alias("hash")))


def range_buckets(left: DataFrame, right: DataFrame, by: Sequence[str], on: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_b``, the number of a sampled range of (key, time,
    side, row): Spark cuts the ranges evenly, so hot keys, bursts and equal
    times are spread, and a key's ranges ascend in time and ``TIE``.  Both sides
    are dealt out together and written once."""
    import uuid

    from voxelframe.session import table_path
    spark = left.sparkSession

    def tagged(df, side, own, other, other_type):
        row = F.struct(*[F.col(c) for c in df.columns])
        tie = F.col(TIE) if side == 0 else F.lit(None).cast(right.schema[TIE].dataType)
        hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        return df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*by, on])], F.lit(side).alias("_side"),
                         tie.alias("_order"), F.xxhash64(*hashed).alias("_row"), row.alias(own),
                         F.lit(None).cast(other_type).alias(other))
    both = tagged(left, 1, "_l", "_r", right.schema).unionByName(tagged(right, 0, "_r", "_l", left.schema))
    order = [*[f"_k{i}" for i in range(len(by) + 1)], "_side", "_order", "_row"]
    # several ranges per later task, so that hashing them evens out
    parts = RANGES_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartitionByRange(parts, *order).select("_side", "_l", "_r", F.spark_partition_id().alias("_b"))
    path = table_path(spark, f"asof_{uuid.uuid4().hex}")
    both.write.parquet(path)
    both = spark.read.schema(both.schema).parquet(path)
    return (both.filter("_side = 1").select(*[F.col("_l")[c].alias(c) for c in left.columns], "_b"),
            both.filter("_side = 0").select(*[F.col("_r")[c].alias(c) for c in right.columns], "_b"))


def _with_buckets(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, bucket) -> tuple[DataFrame, DataFrame]:
    """Attach the time bucket ``_b`` to both sides."""
    if bucket == "auto":
        return range_buckets(left, right, by, on)
    return left.withColumn("_b", _bucket(on, bucket)), right.withColumn("_b", _bucket(on, bucket))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], on: str,
              bucket: Callable[[Column], Column] | None = None,
              right_prefix: str = "", tie_break: Sequence[str] = ()) -> DataFrame:
    """Left rows with the payload columns of the matched right row.

    ``bucket`` maps the time column to a bucket id that is monotone in time
    (e.g. ``lambda c: F.to_date(c)``); ``"auto"`` cuts even ranges of key and
    time (``range_buckets``); None means one bucket per key.
    Right payload columns are renamed with ``right_prefix``; the right time
    is returned as ``right_prefix + on`` when a prefix is given.
    ``tie_break`` names right columns that order right rows of equal time.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in by and c != on]
    out_names = {c: right_prefix + c for c in payload}
    rt_name = right_prefix + on if right_prefix else None
    lcols = left.columns
    clash = set(lcols) & (set(out_names.values()) | ({rt_name} if rt_name else set()))
    if clash:
        raise ValueError(f"right columns {sorted(clash)} clash with left columns; set right_prefix")

    rstruct = F.struct(F.col(on).alias("_rt"), *[F.col(c).alias(out_names[c]) for c in payload])
    L, R = _with_buckets(left, _with_tie(right, by, on, tie_break), by, on, bucket)
    L = L.withColumn("_side", F.lit(1))
    R = R.withColumn("_side", F.lit(0)).select(*by, on, "_b", "_side", TIE, rstruct.alias("_r"))

    # (1) within bucket; right rows sort before left rows at equal time (<=)
    u = L.withColumn("_r", F.lit(None).cast(R.schema["_r"].dataType)).unionByName(
        R, allowMissingColumns=True)
    w = (Window.partitionBy(*by, "_b").orderBy(F.col(on), F.col("_side"), F.col(TIE))
               .rowsBetween(Window.unboundedPreceding, 0))
    inb = (u.repartition(*by, "_b").withColumn("_m", F.last("_r", ignorenulls=True).over(w))
             .filter(F.col("_side") == 1).drop("_r", "_side", TIE))

    # (2) last right row per (key, bucket), carried into later buckets
    last_r = R.groupBy(*by, "_b").agg(F.max_by("_r", F.struct(F.col(on), F.col(TIE))).alias("_r"))
    lkeys = L.select(*by, "_b").distinct().withColumn("_side", F.lit(0))
    ku = lkeys.withColumn("_r", F.lit(None).cast(R.schema["_r"].dataType)).unionByName(
        last_r.withColumn("_side", F.lit(1)))
    wk = (Window.partitionBy(*by).orderBy(F.col("_b"), F.col("_side"))
                .rowsBetween(Window.unboundedPreceding, 0))
    carry = (ku.withColumn("_c", F.last("_r", ignorenulls=True).over(wk))
               .filter(F.col("_side") == 0).select(*by, "_b", "_c"))

    j = inb.join(carry, [*by, "_b"], "left")
    m = F.when(F.col(on).isNotNull(), F.coalesce(F.col("_m"), F.col("_c")))
    sel = [F.col(c) for c in lcols]
    if rt_name:
        sel.append(m["_rt"].alias(rt_name))
    sel += [m[out_names[c]].alias(out_names[c]) for c in payload]
    return j.select(*sel)


def asof_cogroup(left: DataFrame, right: DataFrame, by: Sequence[str], on: str,
                 schema: str, bucket: Callable[[Column], Column] | None = None,
                 key_buckets: int | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """Same semantics through ``cogroup().applyInPandas`` with
    ``pandas.merge_asof(by=...)``.

    Groups are (hash bucket of the key, time bucket): many keys share one
    Python call (few calls), and one key's rows are cut by time (bounded
    calls).  Each group's right side is that time bucket's rows plus, per
    key, the one row carried in from earlier buckets.  ``key_buckets``
    defaults to the session's shuffle partition count, which is sized to
    the data (``session.cluster_conf``), so a group holds about one
    partition's share of one time bucket.
    """
    by = list(by)
    if key_buckets is None:
        key_buckets = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # fresh attributes on each side: when both sides come from one scan they
    # share attribute ids, and the cogrouped Python runner must not mistake
    # the right side's key/time columns for the left's
    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    # a sampled range is a group of its own
    hb = F.lit(0) if bucket == "auto" else F.pmod(F.xxhash64(*[F.col(c) for c in by]), F.lit(key_buckets))
    L, R = _with_buckets(left, _with_tie(right, by, on, tie_break), by, on, bucket)
    L = L.withColumn("_hb", hb)
    R = R.withColumn("_hb", hb)
    payload = [c for c in right.columns if c not in by and c != on]
    ties = [f"_t{i}" for i in range(len(tie_break) + 1)]
    R = R.select("*", *[F.col(TIE)[f].alias(t) for f, t in zip(R.schema[TIE].dataType.names, ties)])

    # carried-in right row for each (key, bucket) that has left rows
    last_r = R.groupBy(*by, "_b").agg(F.max_by(F.struct(on, *payload, *ties), F.struct(F.col(on), F.col(TIE))).alias("_r"))
    lkeys = L.select(*by, "_b").distinct().withColumn("_side", F.lit(0))
    ku = lkeys.withColumn("_r", F.lit(None).cast(last_r.schema["_r"].dataType)).unionByName(
        last_r.withColumn("_side", F.lit(1)))
    wk = (Window.partitionBy(*by).orderBy(F.col("_b"), F.col("_side"))
                .rowsBetween(Window.unboundedPreceding, -1))
    carried = (ku.withColumn("_c", F.last("_r", ignorenulls=True).over(wk))
                 .filter((F.col("_side") == 0) & F.col("_c").isNotNull())
                 .select(*by, "_b", "_c.*").withColumn("_hb", hb))
    cols = [*by, "_b", "_hb", on, *payload, *ties]
    R2 = R.select(*cols).unionByName(carried.select(*cols))

    def merge(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        lp = lp.drop(columns=["_b", "_hb"])
        timed = lp[lp[[on, *by]].notna().all(axis=1)].sort_values(on, kind="stable")
        if rp.empty or timed.empty:
            return lp.assign(**{c: None for c in payload})
        rp = rp.sort_values([on, *ties], kind="stable", na_position="first").drop(columns=["_b", "_hb", *ties])
        # the key's type follows the left side, which may hold nulls
        rp = rp.astype({c: timed[c].dtype for c in [on, *by]})
        found = pd.merge_asof(timed, rp, on=on, by=by, direction="backward").set_index(timed.index)
        return lp.join(found[payload])

    return L.groupBy("_hb", "_b").cogroup(R2.groupBy("_hb", "_b")).applyInPandas(merge, schema)

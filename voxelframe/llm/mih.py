"""Approximate nearest neighbours by multi-index hashing.

Unit vectors are projected on their principal directions and rotated so that
the signs lose as little as possible (iterative quantisation, learned on a
bounded sample); several rotations are concatenated to a code of ``BITS``
bits.  The code is split into ``TABLES`` substrings and each substring is an
index of its own.  A code within Hamming radius r of a query has at least one
substring within r // TABLES of the query's, so probing the buckets at that
substring radius retrieves every code within r.  Codes within r are reranked
by the cosine of the original vectors.  A query that finds fewer than ``k``
rows is asked again with the full radius, which retrieves every row.

Two layouts give the same rows; which one is used depends on the share of rows
that probing would touch, measured on the sample:

* index: every row is entered under its ``TABLES`` keys (table, substring), a
  query is sent to the substrings it probes, and an equi-join finds the pairs.
  A pair is kept at the first table that finds it, if its codes are within the
  radius, and only then gets its vectors.
* blocks: where vectors have so little structure that a radius that finds the
  neighbours covers much of the code space, probing finds most rows anyway;
  rows and queries are then dealt into blocks, and a task holds the index of
  one block of rows and one block of queries.

Vectors of different lengths are tables of their own.
"""

from __future__ import annotations

from functools import partial
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxelframe.llm.common import group_slices, shuffle_parts, staged
from voxelframe.llm.vectors import component_type, flatten, matrix, unit

SEED = 11
BITS = 128
TABLES = 8
# bound of the learning sample: rows, and bytes as doubles
SAMPLE_ROWS = 8192
SAMPLE_BYTES = 64 << 20
SAMPLE_QUERIES = 512
# share of the sample's true neighbours that the radius must cover
COVER = 0.99
MAX_BLOCK = 16384
QUERY_BLOCK = 2048
# the index is used if probing touches at most this share of the rows, with at
# most so many substrings a table
MAX_SHARE = 0.05
MAX_PROBES = 700
MAX_LENGTHS = 1000


def fit_codes(x, bits: int = BITS, rounds: int = 20):
    """Projection (dims x bits) whose signs are the codes of unit rows."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    width = min(x.shape[1], 64)
    _, vecs = np.linalg.eigh(x.T @ x)
    axes = vecs[:, ::-1][:, :width]
    v, parts = x @ axes, []
    for _ in range(ceil(bits / width)):
        r = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(rounds):
            b = np.where(v @ r > 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(b.T @ v)
            r = (u @ w).T
        parts.append(axes @ r)
    return np.hstack(parts)[:, :bits]


def codes(x, projection):
    """Signs of the projected rows as 16-bit substrings (rows x TABLES)."""
    import numpy as np
    return np.packbits(x @ projection > 0, axis=1).view(">u2").astype(np.uint16)


def fit_radius(x, projection, k: int, cover: float = COVER) -> int:
    """Hamming radius that covers ``cover`` of the sample's true neighbours.
    Neighbours in a sample are farther than in the whole table, so the whole
    table is covered at least as well."""
    import numpy as np
    c = codes(x, projection)
    n = min(len(x), SAMPLE_QUERIES)
    if n < 2:
        return BITS
    sims = x[:n] @ x.T
    sims[np.arange(n), np.arange(n)] = -2
    k = min(k, len(x) - 1)
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    away = np.bitwise_count(c[:n, None, :] ^ c[best]).sum(-1)
    return int(np.quantile(away, cover, method="higher"))


def search_block(rows, ids, queries, query_ids, projection, radius: int, k: int):
    """(query position, row position, cosine): the best ``k`` rows of each
    query among those whose code is within ``radius``.  Unit rows in double."""
    import numpy as np
    base, probe = codes(rows, projection), codes(queries, projection)
    index = []
    for t in range(TABLES):
        order = np.argsort(base[:, t], kind="stable")
        values, counts = np.unique(base[order, t], return_counts=True)
        index.append((order, values, counts))
    near = radius // TABLES
    qs, rs, ss = [], [], []
    for at in range(0, len(probe), 64):
        part = probe[at:at + 64]
        found = np.zeros((len(part), len(base)), bool)
        for t, (order, values, counts) in enumerate(index):
            hit = np.bitwise_count(values[None, :] ^ part[:, t, None]) <= near
            found[:, order] |= np.repeat(hit, counts, axis=1)
        found &= ids[None, :] != query_ids[at:at + 64, None]
        q, r = np.nonzero(found)
        away = np.bitwise_count(base[r].view(np.uint64) ^ part[q].view(np.uint64)).sum(1)
        q, r = q[away <= radius], r[away <= radius]
        sims = np.clip((queries[at + q] * rows[r]).sum(1), -1, 1)
        best = np.lexsort((ids[r], -sims, q))
        q, r, sims = q[best], r[best], sims[best]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < k
        qs.append(at + q[keep])
        rs.append(r[keep])
        ss.append(sims[keep])
    return np.concatenate(qs), np.concatenate(rs), np.concatenate(ss)


def _search(batches, projection, radius: int, k: int, kind: str):
    import numpy as np
    import pyarrow as pa
    for t in group_slices(batches):
        pair, asks, ids = (t.column(i).to_numpy() for i in range(3))
        start = [0, *(np.flatnonzero(np.diff(pair)) + 1).tolist(), len(pair)]
        for s, e in zip(start, start[1:]):
            x = unit(matrix(t.column(3).slice(s, e - s), kind))
            own, q = ids[s:e], np.flatnonzero(asks[s:e] == 1)
            r = np.flatnonzero(asks[s:e] == 0)
            if len(q) and len(r):
                a, b, sims = search_block(x[r], own[r], x[q], own[q], projection, radius, k)
                yield pa.RecordBatch.from_arrays([pa.array(own[q][a]), pa.array(own[r][b]), pa.array(sims)],
                                                 names=["query_id", "vec_id", "score"])


def _pairs(rows: DataFrame, queries: DataFrame, n: int, n_queries: int, projection, radius, k, kind) -> DataFrame:
    parts = shuffle_parts(rows.sparkSession)
    block = min(MAX_BLOCK, max(512, ceil(n / (2 * parts))))
    n_rows, n_asks = max(1, ceil(n / block)), max(1, ceil(n_queries / QUERY_BLOCK))

    def dealt(df, of, across, place, asks):
        own = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(of))
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(across - 1).cast("bigint")))
        return df.select(own.alias("own"), every.alias("other"), "vec_id", "vec").select(
            place.alias("pair"), F.lit(asks).alias("asks"), "vec_id", "vec")
    both = dealt(rows, n_rows, n_asks, F.col("other") * n_rows + F.col("own"), 0).unionAll(
        dealt(queries, n_asks, n_rows, F.col("own") * n_rows + F.col("other"), 1))
    return (both.repartitionByRange(max(parts, min(n_rows * n_asks, 8 * parts)), "pair").sortWithinPartitions("pair")
            .mapInArrow(partial(_search, projection=projection, radius=radius, k=k, kind=kind),
                        "query_id bigint, vec_id bigint, score double"))


def probes(near: int) -> list[int]:
    """The 16-bit masks of at most ``near`` bits."""
    return [m for m in range(1 << 16) if m.bit_count() <= near]


def probed_share(x, projection, radius: int) -> float:
    """Share of the sample's rows that a query of it finds in some table."""
    import numpy as np
    c = codes(x, projection)
    some = c[:SAMPLE_QUERIES]
    hit = np.zeros((len(some), len(c)), bool)
    for t in range(TABLES):
        hit |= np.bitwise_count(c[None, :, t] ^ some[:, t, None]) <= radius // TABLES
    return float(hit.mean())


def _coded(batches, projection, kind):
    """Rows (.., vec) with their code as two 64-bit numbers, table 0 lowest."""
    import numpy as np
    import pyarrow as pa
    for b in batches:
        if not b.num_rows:
            continue
        c = codes(unit(matrix(b.column(b.num_columns - 1), kind)), projection).astype(np.uint64)
        half = [sum(c[:, h + t] << np.uint64(16 * t) for t in range(4)).view(np.int64) for h in (0, 4)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, half)], names=[*b.schema.names[:-1], "c0", "c1"])


def _substring(t: int, side: str = ""):
    return F.shiftrightunsigned(F.col(f"{side}c{t // 4}"), 16 * (t % 4)).bitwiseAND(F.lit(0xFFFF))


def _cosines(batches, kind):
    import numpy as np
    import pyarrow as pa
    for b in batches:
        if b.num_rows:
            x, y = (unit(matrix(b.column(i), kind)) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.clip((x * y).sum(1), -1, 1))],
                                             names=["query_id", "vec_id", "score"])


def _indexed(rows: DataFrame, queries: DataFrame, projection, radius: int, kind) -> DataFrame:
    """All (query, row) within the radius and their cosines, by the index.
    ``rows`` have a number ``rid`` of their own."""
    coded = staged(rows.select("rid", "vec_id", "vec").mapInArrow(
        partial(_coded, projection=projection, kind=kind), "rid bigint, vec_id bigint, c0 bigint, c1 bigint"), "codes")
    asked = staged(queries.select("vec_id", "vec").mapInArrow(
        partial(_coded, projection=projection, kind=kind), "vec_id bigint, c0 bigint, c1 bigint"), "query-codes")
    near = radius // TABLES
    keys = F.array(*[F.struct(F.lit(t).alias("t"), _substring(t).alias("s")) for t in range(TABLES)])
    entered = coded.select("rid", F.col("vec_id").alias("row_id"), F.col("c0").alias("r_c0"), F.col("c1").alias("r_c1"),
                           F.explode(keys).alias("k")).select("rid", "row_id", "r_c0", "r_c1", "k.t", "k.s")
    masks = F.array(*[F.lit(m) for m in probes(near)])
    sent = asked.select("vec_id", "c0", "c1", F.explode(keys).alias("k")).select(
        F.col("vec_id").alias("query_id"), F.col("c0").alias("q_c0"), F.col("c1").alias("q_c1"), F.col("k.t").alias("t"),
        F.explode(F.transform(masks, lambda m: F.col("k.s").bitwiseXOR(m.cast("bigint")))).alias("s"))
    met = sent.join(entered, ["t", "s"]).filter("query_id <> row_id")
    met = met.withColumns({"c0": F.col("q_c0").bitwiseXOR(F.col("r_c0")), "c1": F.col("q_c1").bitwiseXOR(F.col("r_c1"))})
    # at the first table that finds the pair
    earlier = F.lit(False)
    for t in range(TABLES - 1):
        earlier = earlier | ((F.col("t") > t) & (F.bit_count(_substring(t)) <= near))
    pairs = met.filter(~earlier & (F.bit_count("c0") + F.bit_count("c1") <= radius)).select("query_id", "rid", "row_id")
    full = (pairs.join(rows.select("rid", F.col("vec").alias("row_vec")), "rid")
            .join(queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("query_vec")), "query_id"))
    return full.select("query_id", F.col("row_id").alias("vec_id"), "query_vec", "row_vec").mapInArrow(
        partial(_cosines, kind=kind), "query_id bigint, vec_id bigint, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def nearest(table: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", max_share: float = MAX_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of every
    row for which the Column ``is_query`` holds; score is the cosine.

    Candidates are all rows with another id and as many components; ties go to
    the smaller id.  Vectors that are null, empty, zero or hold null or
    non-finite components and rows with a null id take no part.  Of rows with
    equal id and vector one counts; a query id with several vectors of a length
    is asked with the smallest by bytes, one with vectors of several lengths
    has the best ``k`` rows of all.  With fewer than ``k`` candidates all are
    returned.  More than ``MAX_LENGTHS`` different lengths raise.  Other columns
    are not read."""
    kind = component_type(table, vector_col)
    size = 4 if kind == "<f4" else 8
    flag = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"),
                        F.coalesce(is_query, F.lit(False)).alias("asks")).filter("vec_id is not null")
    rows = flatten(flag, "embedding", {"vec_id": "bigint", "asks": "boolean"})
    rows = staged(rows.withColumn("dim", (F.length("vec") / size).cast("int")), "vectors")
    lengths = rows.groupBy("dim").agg(F.max("asks").alias("asks")).limit(MAX_LENGTHS + 1).collect()
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    found = None
    for dim in sorted(r["dim"] for r in lengths if r["asks"]):
        own = rows.filter(F.col("dim") == dim).groupBy("vec_id", "vec").agg(F.max("asks").alias("asks"))
        some = _nearest_of_length(staged(own.withColumn("rid", F.monotonically_increasing_id()), "distinct-vectors"),
                                  dim, k, kind, max_share)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return table.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if sum(bool(r["asks"]) for r in lengths) > 1:
        found = _best(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _nearest_of_length(rows: DataFrame, dim: int, k: int, kind: str, max_share: float) -> DataFrame:
    """The same for rows (rid, vec_id, vec, asks) of one length."""
    queries = rows.filter("asks").groupBy("vec_id").agg(F.min("vec").alias("vec"))
    n, n_ids, n_queries = rows.agg(F.count("*"), F.countDistinct("vec_id"),
                                   F.countDistinct(F.when(F.col("asks"), F.col("vec_id")))).first()
    # the learning sample: the rows with the smallest hashes
    few = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim) + 2)
    sample = rows.select("vec_id", "vec").orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id", "vec").limit(few)
    import numpy as np
    x = unit(np.stack([np.frombuffer(r["vec"], kind) for r in sample.collect()]).astype(np.float64))
    projection = fit_codes(x)
    radius = fit_radius(x, projection, k)
    if len(probes(radius // TABLES)) <= MAX_PROBES and probed_share(x, projection, radius) <= max_share:
        found = _best(_indexed(rows, queries, projection, radius, kind), k)
    else:
        found = _best(_pairs(rows.select("vec_id", "vec"), queries, n, n_queries, projection, radius, k, kind), k)
    found = staged(found, "neighbours")
    got = found.groupBy("query_id").count().filter(F.col("count") >= min(k, n_ids - 1))
    short = staged(queries.join(got, queries.vec_id == got.query_id, "left_anti"), "short-queries")
    n_short = short.count()
    if n_short:
        again = _best(_pairs(rows.select("vec_id", "vec"), short, n, n_short, projection, BITS, k, kind), k)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(
            *found.columns).unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")

"""SimHash near-duplicates by pivot distance tables.

A fingerprint's pivot table row holds its Hamming distances to ``N_PIVOTS``
seeded random reference fingerprints.  By the triangle inequality a pair of
which a coordinate differs by more than ``d`` is discarded, and only the
survivors' fingerprints are compared bit by bit.

Pivots alone do not bound the pairs: distances to a random reference lie
within 32 +- 4, so 16 pivots still leave one of 83,000 unrelated pairs
(measured), and every pair would have to be looked at to find it.  So the pairs that meet at all come from blocks: of ``m`` disjoint groups
of bits, a pair with at most ``d`` differing bits agrees on at least ``m - d``;
each choice of ``m - d`` groups is one table of blocks, and every linked pair
shares a block in some table.

Equal fingerprints are merged first, so groups of copies cost one row.  A
block over ``PIECE`` fingerprints is dealt out as pairs of pieces; a task
emits at most a spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.llm.common import group_slices, staged
from voxelframe.llm.graph import connected_components

SEED = 42
N_PIVOTS = 16
PIECE = 1024
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of a text's word shingles (XXH64 with seed 42): a bit is
    set if it is set in over half of the hashes, repeats included."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh
    words = text.translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxh(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[:n - shingle] + 1).tolist()]
    h = np.array([xxh(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(batches, shingle: int):
    import numpy as np
    import pyarrow as pa
    for b in batches:
        fps = np.array([fingerprint(t.as_py() or b"", shingle) for t in b.column(1)], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the fingerprint as a signed
    bigint.  Null texts count as empty (fingerprint zero); null ids stay."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id bigint, fp bigint")


def block_tables(n: int, max_bits: int) -> list[int]:
    """Bit masks of the block tables for ``n`` fingerprints.  The number of
    groups changes only the work, never the pairs found."""
    def cost(m):
        kept = 64 * (m - max_bits) // m
        return comb(m, max_bits) * (20 + n / 2 ** (kept + 1))
    m = min(range(max_bits + 1, max_bits + 7), key=cost)
    edge = [64 * i // m for i in range(m + 1)]
    groups = [sum(1 << b for b in range(edge[i], edge[i + 1])) for i in range(m)]
    return [sum(c) for c in combinations(groups, m - max_bits)]


def _forest(a, b, n):
    """Smallest row index connected to each of ``n`` rows by the pairs (a, b)."""
    import numpy as np
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _block_links(batches, max_bits: int):
    import numpy as np
    import pyarrow as pa
    pivots = np.random.default_rng(SEED).integers(0, 2 ** 64, N_PIVOTS, np.uint64)
    for t in group_slices(batches):
        block, fp = t.column(0).to_numpy(), t.column(1).to_numpy().view(np.uint64)
        table = np.bitwise_count(fp[:, None] ^ pivots).astype(np.int8)
        left, right = [], []
        live = np.arange(len(fp))
        step = 1
        while True:
            live = live[live + step < len(fp)]
            live = live[block[live] == block[live + step]]
            if not len(live):
                break
            i = live
            for p in range(N_PIVOTS):
                i = i[np.abs(table[i, p] - table[i + step, p]) <= max_bits]
            i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= max_bits]
            left.append(i)
            right.append(i + step)
            step += 1
        if left:
            low = _forest(np.concatenate(left), np.concatenate(right), len(fp))
            at = np.flatnonzero(low != np.arange(len(fp)))
            fps = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(fps[at]), pa.array(fps[low[at]])], names=["a", "b"])


def fingerprint_links(fps: DataFrame, n: int, max_bits: int) -> DataFrame:
    """Links (a, b) that connect all of the distinct fingerprints ``fps``
    (column fp, ``n`` rows) at ``max_bits`` or fewer differing bits."""
    def signed(mask):
        return mask - (1 << 64) if mask >> 63 else mask
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m))))
            for i, m in enumerate(block_tables(n, max_bits))]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("block"))
    size = rows.groupBy("block").count().filter(F.col("count") > PIECE)
    hot = size.select("block", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces"))
    rows = rows.join(hot, "block", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    piece = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.col("pieces")).cast("int")
    rows = (rows.withColumn("piece", piece)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
            .select(F.when(F.col("pieces") == 1, F.col("block"))
                    .otherwise(F.xxhash64("block", F.least("piece", "other"), F.greatest("piece", "other")))
                    .alias("block"), "fp"))
    return (rows.repartition("block").sortWithinPartitions("block", "fp")
            .mapInArrow(partial(_block_links, max_bits=max_bits), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (bigint), component_id.

    Texts whose fingerprints differ in ``max_bits`` or fewer bits are linked;
    component_id is the smallest doc_id reachable.  Null and empty texts have
    fingerprint zero and link like any other.  Rows with a null id take part;
    their component_id is the smallest id of the group, null if no member has
    one.  Repeated rows are copies of each other.  Columns other than the id
    and the text are not read."""
    rows = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    low = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    comp = connected_components(fingerprint_links(low.select("fp"), low.count(), max_bits))
    named = low.join(comp, low.fp == comp.node, "left").select("fp", "low", F.coalesce("component", "fp").alias("comp"))
    named = staged(named, "fingerprint-components")
    best = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    label = named.join(best, "comp").select("fp", "component_id")
    return rows.join(label, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns kept.

    The row with the smallest id stays (ids before null); a group without any
    id keeps one row.  Of repeated rows with that id one stays."""
    from voxelframe.operators.joins import sized_broadcast
    rows = near_duplicates(docs.select(F.col(id_col), F.col(text_col)), shingle, max_bits, id_col, text_col)
    rows = staged(rows, "labelled")
    chosen = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = staged(rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(chosen).alias("kept")), "ids")
    key = F.col(id_col).cast("bigint")
    # names of the look-up columns that no column of the documents has
    free = "look_up"
    while any(c.lower() == free for c in docs.columns):
        free += "_"
    # ids that stay as they are need no look-up: the others are few, or are shuffled
    out = ids.filter("doc_id is not null and (n > 1 or not kept)").select(F.col("doc_id").alias(free))
    clean = docs.filter(key.isNotNull()).join(sized_broadcast(out), key == F.col(free), "left_anti")
    odd = ids.filter("n > 1 or doc_id is null").select(F.col("doc_id").alias(free))
    if odd.isEmpty():
        return clean
    # repeated or missing ids: rows are told apart by fingerprint, and one of
    # each is chosen by partially aggregated minima
    again = docs.join(sized_broadcast(odd), key.eqNullSafe(F.col(free)), "left_semi")
    tagged = again.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), key.alias("row_id"),
                          _fp_udf(shingle)(F.col(text_col).cast("binary")).alias("fp"))
    first = F.min_by("row", F.struct("fp", F.col("row")[text_col])).alias("row")
    best = rows.filter(chosen & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("best_id")).agg(
        F.min("fp").alias("best_fp"))
    with_id = (tagged.join(best, (F.col("row_id") == F.col("best_id")) & (F.col("fp") == F.col("best_fp")), "left_semi")
               .groupBy("row_id").agg(first).select("row.*"))
    reps = _null_representatives(rows.filter("doc_id is null and component_id is null").select("fp").distinct(), max_bits)
    no_id = (tagged.filter(F.col("row_id").isNull()).join(reps, F.col("fp") == F.col("rep"), "left_semi")
             .groupBy("fp").agg(first).select("row.*"))
    return clean.unionByName(with_id).unionByName(no_id)


def _fp_udf(shingle: int):
    from pyspark.sql.functions import PandasUDFType, pandas_udf

    def fp(texts):
        import numpy as np
        import pandas as pd
        return pd.Series(np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64))
    return pandas_udf(fp, "bigint", PandasUDFType.SCALAR)


def _null_representatives(ids: DataFrame, max_bits: int) -> DataFrame:
    """The smallest fingerprint of every group whose members have no id."""
    fps = staged(ids, "null-ids")
    comp = connected_components(fingerprint_links(fps, fps.count(), max_bits))
    named = fps.join(comp, fps.fp == comp.node, "left")
    return named.select(F.coalesce("component", "fp").alias("rep")).distinct()

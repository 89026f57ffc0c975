"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source) cells.  Weights are propagated from the
root: a node's budget is split among its children in proportion to their
weights, but no subtree gets more than it can supply (its tokens times
``max_epochs``).  What one child cannot supply goes to its siblings, by weight;
only what all of them cannot supply stays with the ancestors, because a node
asks for no more than its subtree holds.  The split is a closed form over
prefix sums of the children ordered by supply per weight, in integers.

A leaf's budget is filled from seeded epochs: whole passes over its documents,
each in its own random order, and a prefix of the next pass.  Prefix sums are
taken per (leaf, slice of the order) and shifted by the slices before, so a
leaf with a third of all rows is spread over its slices.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxelframe.llm.common import staged

LEVELS = ["domain", "lang", "source"]
SLICE_ROWS = 50_000
MIN_DIGITS = 2
OTHER_WEIGHT = 1


def word_tokens(text: Column) -> Column:
    """Default measure: words between ASCII white space, null as none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(path: list[str], known: dict[tuple, int]) -> Column:
    if any(int(v) != v or v < 1 for v in known.values()):
        raise ValueError("weights are positive integers")
    w = F.lit(OTHER_WEIGHT)
    for names, value in known.items():
        match = F.lit(True)
        for column, name in zip(path, names):
            match = match & (F.col(column) == F.lit(name))
        w = F.when(match, F.lit(int(value))).otherwise(w)
    return w.cast("bigint")


def _split(children: DataFrame, parent: list[str]) -> DataFrame:
    """Children (parent..., name, weight, supply) with their parent's budget
    ``given`` -> their own budgets.

    In order of supply / weight a child is filled to its supply while that is
    no more than its share of what is left; the others share the rest by
    weight, rounded down, and the remainder goes to the first of them, one
    token each."""
    by = W.partitionBy(*parent)
    line = by.orderBy("ratio", "name")
    ahead = line.rowsBetween(W.unboundedPreceding, -1)
    upto = line.rowsBetween(W.unboundedPreceding, 0)
    wide = "decimal(19,0)"
    d = children.withColumn("ratio", F.col("supply") / F.col("weight"))
    d = (d.withColumn("before", F.coalesce(F.sum("supply").over(ahead), F.lit(0)))
         .withColumn("open", F.sum("weight").over(by) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)))
         .withColumn("full", F.col("supply").cast(wide) * F.col("open").cast(wide)
                     <= (F.col("given") - F.col("before")).cast(wide) * F.col("weight").cast(wide)))
    d = (d.withColumn("rest", F.col("given") - F.sum(F.expr("if(full, supply, 0)")).over(by))
         .withColumn("open", F.sum(F.expr("if(full, 0, weight)")).over(by))
         .withColumn("share", F.expr(f"if(full, supply, (cast(rest as {wide}) * cast(weight as {wide})) div open)"))
         .withColumn("spare", F.col("given") - F.sum("share").over(by))
         .withColumn("place", F.sum(F.expr("if(full, 0, 1)")).over(upto)))
    more = F.expr("if(not full and place <= spare, 1, 0)")
    return d.select(*parent, "name", (F.col("share") + more).cast("bigint").alias("budget"))


def leaf_budgets(leaves: DataFrame, weights: list[dict[tuple, int]], per_mille: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with budget.

    ``weights[level]`` maps a path down to that level (a tuple of names) to
    its positive integer weight among its siblings; paths without an entry
    weigh ``OTHER_WEIGHT``.  The root's budget is ``per_mille`` thousandths of
    all tokens, at most what ``max_epochs`` passes over all leaves hold."""
    total = leaves.agg(F.sum("tokens")).first()[0] or 0                       # one number
    given = min(int(total) * int(per_mille) // 1000, int(total) * int(max_epochs))
    nodes = None
    for depth, level in enumerate(LEVELS):
        parent, path = LEVELS[:depth], LEVELS[:depth + 1]
        children = (leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("supply"))
                    .withColumn("weight", _weight(path, weights[depth] if depth < len(weights) else {}))
                    .withColumnRenamed(level, "name"))
        children = children.join(nodes, parent) if parent else children.withColumn("given", F.lit(given).cast("bigint"))
        nodes = _split(children, parent).select(*parent, F.col("name").alias(level), F.col("budget").alias("given"))
    return leaves.join(nodes, LEVELS).select(*LEVELS, "tokens", F.col("given").alias("budget"))


def order_key(seed: int, epoch, id_col) -> Column:
    """Place of a document in an epoch's random order (hexadecimal digits)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def _named(docs: DataFrame, id_col: str, path: dict[str, Column], tokens: Column) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"),
                       *[F.coalesce(path[c].cast("string"), F.lit("")).alias(c) for c in LEVELS],
                       F.coalesce(tokens, F.lit(0)).cast("bigint").alias("n_tokens"))


def select_mix(docs: DataFrame, path: dict[str, Column], weights: list[dict[tuple, int]], per_mille: int = 1000,
               max_epochs: int = 2, seed: int = 17, tokens: Column | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows chosen: doc_id, domain, lang, source, n_tokens, epoch, upto.

    A leaf of T tokens and budget B gets B div T whole epochs, and of the next
    one the prefix of documents, in the epoch's seeded order, whose running
    token sum ``upto`` stays within B mod T.  A document that is chosen in
    several epochs has a row for each.  Null names count as the empty name,
    null texts have no tokens.  Documents without tokens go along with the
    prefix; a leaf without any tokens is passed once, in epoch 0.  Rows with equal ids are
    adjacent in the order and are chosen or left together; null ids are equal.
    Other columns are not read."""
    tokens = word_tokens(F.col(text_col)) if tokens is None else tokens
    rows = staged(_named(docs, id_col, path, tokens), "token-counts")
    return _select(rows, weights, per_mille, max_epochs, seed)


def _select(rows: DataFrame, weights, per_mille: int, max_epochs: int, seed: int) -> DataFrame:
    leaves = staged(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = (leaf_budgets(leaves, weights, per_mille, max_epochs)
            .withColumn("whole", F.expr("if(tokens = 0, 1, budget div tokens)").cast("int"))
            .withColumn("part", F.expr("if(tokens = 0, 0, budget % tokens)")))
    plan = staged(plan, "budgets")
    digits = max(MIN_DIGITS, ceil(log(max(rows.count(), 1) / SLICE_ROWS + 1, 16)))
    last = F.expr(f"least(if(part > 0, whole, whole - 1), {int(max_epochs) - 1})")
    asked = (rows.join(plan, LEVELS).filter(last >= 0)
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
             .withColumn("key", order_key(seed, F.col("epoch"), F.col("doc_id")))
             .withColumn("slice", F.substring("key", 1, digits)))
    cell = [*LEVELS, "epoch", "slice"]
    sums = asked.groupBy(*cell).agg(F.sum("n_tokens").alias("slice_tokens"))
    ahead = W.partitionBy(*LEVELS, "epoch").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("slice_tokens").over(ahead), F.lit(0))).drop("slice_tokens")
    inside = W.partitionBy(*cell).orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    placed = (asked.withColumn("inside", F.sum("n_tokens").over(inside)).join(sums, cell)
              .withColumn("upto", F.col("before") + F.col("inside")))
    return (placed.filter((F.col("epoch") < F.col("whole")) | (F.col("upto") <= F.col("part")))
            .select("doc_id", *LEVELS, "n_tokens", "epoch", "upto"))


def mix(docs: DataFrame, path: dict[str, Column], weights: list[dict[tuple, int]], per_mille: int = 1000,
        max_epochs: int = 2, seed: int = 17, tokens: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """``docs`` as chosen by ``select_mix``, all columns kept, a row for each
    epoch.  The choice of a leaf is a range of its order, so it is applied as
    a filter while the documents are read; texts are not shuffled."""
    picked = select_mix(docs, path, weights, per_mille, max_epochs, seed, tokens, id_col, text_col)
    cuts = picked.groupBy(*LEVELS, "epoch").agg(
        F.max(order_key(seed, F.col("epoch"), F.col("doc_id"))).alias("cut"))
    cuts = staged(cuts.select(*[F.col(c).alias(f"mix_{c}") for c in LEVELS], F.col("epoch").alias("mix_epoch"),
                              F.col("cut").alias("mix_cut")), "cuts")
    names = [F.col(c) for c in docs.columns]
    whole = docs.select(F.struct(*names).alias("mix_row"), F.col(id_col).alias("mix_id"),
                        *[F.coalesce(path[c].cast("string"), F.lit("")).alias(f"at_{c}") for c in LEVELS])
    same = [F.col(f"at_{c}") == F.col(f"mix_{c}") for c in LEVELS]
    return (whole.join(cuts, same).filter(order_key(seed, F.col("mix_epoch"), F.col("mix_id")) <= F.col("mix_cut"))
            .select("mix_row.*"))

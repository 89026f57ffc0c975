"""Formulas (expression trees) as data, evaluated by Spark.

A formula is a nested tuple ``(op, left, right)`` / ``(fn, arg)`` / leaf
(column name or number).  ``render`` turns it into Spark SQL text that
``F.expr`` compiles into the plan -- Catalyst folds constants and codegen
evaluates it with the scan.  Fitness of many formulas is one aggregate
(``avg((f - y)^2)`` per formula); a generation of a search is one job.
"""

from __future__ import annotations

import random
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.functions.numeric import PDIV_EPS, PDIV_FALLBACK, draw, register_sql_functions
from voxelframe.tables import small_table

# The binary operators of the reference's random trees and the
# function sets of the symbolic search.
TREE_OPS = ["*", "+", "-", "/"]
FUNCTION_SET = ["add", "sub", "mul", "div", "sin", "cos"]

_BIN = {"add": "+", "sub": "-", "mul": "*", "+": "+", "-": "-", "*": "*"}


def render(node, dialect: str = "spark") -> str:
    """SQL text of a formula.  Division is protected (|d| <= 0.001 -> 1)."""
    if isinstance(node, (int, float)):
        # a double literal in both dialects (a bare 1.5 would be a decimal)
        return f"CAST({float(node)!r} AS DOUBLE)"
    if isinstance(node, str):
        return node
    op = node[0]
    if op in ("sin", "cos"):
        return f"{op}({render(node[1], dialect)})"
    a, b = render(node[1], dialect), render(node[2], dialect)
    if op == "div":
        if dialect == "spark":
            return f"pdiv({a}, {b})"
        return f"(CASE WHEN abs({b}) > {PDIV_EPS} THEN ({a}) / ({b}) ELSE {PDIV_FALLBACK} END)"
    if op == "/":
        # plain division of the hand-built trees; by zero -> null
        if dialect == "spark":
            return f"try_divide({a}, {b})"
        return f"(({a}) / NULLIF({b}, 0))"
    return f"({a} {_BIN[op]} {b})"


def length(node) -> int:
    """Number of nodes (the parsimony length)."""
    if isinstance(node, (int, float, str)):
        return 1
    return 1 + sum(length(c) for c in node[1:])


def evaluate(df: DataFrame, formulas: dict, keep: Sequence[str]) -> DataFrame:
    """One column ``f<id>`` per formula next to the ``keep`` columns."""
    register_sql_functions(df.sparkSession)
    return df.select(*keep, *[F.expr(render(f)).alias(f"f{fid}") for fid, f in formulas.items()])


def fitness(df: DataFrame, formulas: dict, targets: dict, parsimony: float = 0.0,
            sample_frac: float | None = None, seed: int = 0, id_cols: Sequence[str] = ()) -> DataFrame:
    """(formula_id, region, n, mse, length, fitness) for every formula in one
    pass.  ``sample_frac`` evaluates on a seeded, partition-independent row
    sample (hash of ``id_cols``), like fitting on a subsample."""
    register_sql_functions(df.sparkSession)
    d = df
    if sample_frac is not None:
        h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in id_cols]), F.lit(1_000_000))
        d = d.filter(h < F.lit(int(sample_frac * 1_000_000)))
    aggs = []
    for fid, f in formulas.items():
        e = F.expr(render(f)) - F.col(targets[fid])
        aggs.append(F.avg(e * e).alias(f"m{fid}"))
    row = d.agg(F.count(F.lit(1)).alias("n"), *aggs)
    spark = df.sparkSession
    meta = small_table(spark,
        [(int(fid), targets[fid], int(length(f))) for fid, f in formulas.items()],
        "formula_id bigint, region string, length int")
    stacked = row.select("n", F.explode(F.array(*[
        F.struct(F.lit(int(fid)).cast("bigint").alias("formula_id"), F.col(f"m{fid}").alias("mse"))
        for fid in formulas])).alias("s")).select("n", "s.*")
    return (stacked.join(F.broadcast(meta), "formula_id")
                   .withColumn("fitness", F.col("mse") + F.lit(parsimony) * F.col("length")))


def best_per_region(fit: DataFrame) -> DataFrame:
    """The formula with the lowest fitness for each region."""
    return fit.groupBy("region").agg(F.min_by("formula_id", "fitness").alias("formula_id"),
                                      F.min("fitness").alias("fitness"))


# ------------------------------------------------------------- generation
def random_tree(rng: random.Random, depth: int, leaves: Sequence | None = None):
    """A complete binary tree of the given depth.  Leaves are constants
    uniform in [-2, 2) rounded to 2 decimals (or, when ``leaves`` is given,
    drawn from those column names half of the time)."""
    if depth <= 0:
        if leaves and rng.random() < 0.5:
            return rng.choice(list(leaves))
        return round(rng.random() * 4 - 2, 2)
    op = rng.choice(TREE_OPS)
    return (op, random_tree(rng, depth - 1, leaves), random_tree(rng, depth - 1, leaves))


def seeded_tree(i: int, min_depth: int, max_depth: int, seed: int = 0, leaves: Sequence | None = None):
    """(depth, tree) of the i-th random formula."""
    rng = random.Random(seed * 1_000_003 + i)
    depth = rng.randint(min_depth, max_depth)
    return depth, random_tree(rng, depth, leaves)


def random_formulas(spark, n: int, min_depth: int, max_depth: int, seed: int = 0,
                    leaves: Sequence | None = None) -> DataFrame:
    """``n`` random trees as rows (formula_id, depth, expr, length).

    Generated in a distributed ``mapInPandas`` over ``spark.range(n)``; each
    formula's generator is seeded by (seed, id), so the result does not
    depend on partitioning."""
    import pandas as pd

    def gen(it):
        for pdf in it:
            rows = []
            for i in pdf["id"]:
                depth, t = seeded_tree(int(i), min_depth, max_depth, seed, leaves)
                rows.append((int(i), depth, render(t), length(t)))
            yield pd.DataFrame(rows, columns=["formula_id", "depth", "expr", "length"])

    return spark.range(n).mapInPandas(gen, "formula_id long, depth int, expr string, length int")


def constant_value(node) -> float:
    """Value of a constant-only tree (plain arithmetic, unprotected division
    as in the hand-built trees)."""
    if isinstance(node, (int, float)):
        return float(node)
    a, b = constant_value(node[1]), constant_value(node[2])
    return {"+": a + b, "-": a - b, "*": a * b, "/": a / b if b != 0 else float("inf")}[node[0]]


# ------------------------------------------------------------- NumPy path
def eval_numpy(node, cols: dict):
    """Vectorised value of a tree over column arrays (protected division)."""
    import numpy as np
    if isinstance(node, (int, float)):
        return np.full(len(next(iter(cols.values()))), float(node))
    if isinstance(node, str):
        return cols[node]
    op = node[0]
    if op == "sin":
        return np.sin(eval_numpy(node[1], cols))
    if op == "cos":
        return np.cos(eval_numpy(node[1], cols))
    a, b = eval_numpy(node[1], cols), eval_numpy(node[2], cols)
    if op in ("add", "+"):
        return a + b
    if op in ("sub", "-"):
        return a - b
    if op in ("mul", "*"):
        return a * b
    if op == "/":
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(b == 0, np.nan, a / np.where(b == 0, 1.0, b))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.abs(b) > PDIV_EPS, a / np.where(b == 0, 1.0, b), PDIV_FALLBACK)


def fitness_numpy(df: DataFrame, trees: dict, target: str, features: Sequence[str],
                  parsimony: float = 0.0, sample_frac: float | None = None, seed: int = 0,
                  id_cols: Sequence[str] = ()) -> dict:
    """Fitness of many (or deep) formulas in one pass: each Arrow batch
    evaluates every tree with NumPy and only (formula_id, sse, n) sums leave
    the task.  Returns {formula_id: (mse, fitness)}."""
    import numpy as np
    import pandas as pd

    needed = list(dict.fromkeys([*features, target]))
    d = df.select(*needed, *[c for c in id_cols if c not in needed])
    if sample_frac is not None:
        h = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in id_cols]), F.lit(1_000_000))
        d = d.filter(h < F.lit(int(sample_frac * 1_000_000)))
    feats = list(features)
    bc = df.sparkSession.sparkContext.broadcast(trees)   # the population, once per executor

    def run(it):
        trees = bc.value
        sse = {fid: 0.0 for fid in trees}
        n = 0
        for pdf in it:
            if len(pdf) == 0:
                continue
            cols = {c: pdf[c].to_numpy(dtype=np.float64) for c in feats}
            y = pdf[target].to_numpy(dtype=np.float64)
            n += len(pdf)
            for fid, t in trees.items():
                e = eval_numpy(t, cols) - y
                sse[fid] += float(np.dot(e, e))
        if n:
            yield pd.DataFrame({"formula_id": list(sse), "sse": list(sse.values()), "n": [n] * len(sse)})

    rows = (d.select(*needed).mapInPandas(run, "formula_id long, sse double, n long")
              .groupBy("formula_id").agg(F.sum("sse").alias("sse"), F.sum("n").alias("n")).collect())
    bc.unpersist()
    out = {}
    for r in rows:
        mse = r["sse"] / r["n"] if r["n"] else float("inf")
        if not np.isfinite(mse):
            mse = float("inf")
        out[r["formula_id"]] = (mse, mse + parsimony * length(trees[r["formula_id"]]))
    return out


# ------------------------------------------------------------- search
def _nodes(t, path=()):
    yield path, t
    if isinstance(t, tuple):
        for i, c in enumerate(t[1:], start=1):
            yield from _nodes(c, path + (i,))


def _replace(t, path, new):
    if not path:
        return new
    lst = list(t)
    lst[path[0]] = _replace(t[path[0]], path[1:], new)
    return tuple(lst)


def _random_program(rng, depth, features, const_range, functions):
    if depth <= 0 or (depth < 2 and rng.random() < 0.3):
        if rng.random() < 0.5:
            return rng.choice(list(features))
        return round(rng.uniform(*const_range), 3)
    f = rng.choice(functions)
    if f in ("sin", "cos"):
        return (f, _random_program(rng, depth - 1, features, const_range, functions))
    return (f, _random_program(rng, depth - 1, features, const_range, functions),
            _random_program(rng, depth - 1, features, const_range, functions))


def symbolic_search(df: DataFrame, target: str, features: Sequence[str], population: int = 1000,
                    generations: int = 150, tournament: int = 20, stopping: float = 0.001,
                    const_range=(-1.0, 1.0), init_depth=(6, 10), p_crossover: float = 0.7,
                    p_subtree: float = 0.12, p_hoist: float = 0.06, p_point: float = 0.12,
                    functions: Sequence[str] = ("add", "sub", "mul", "div", "cos"),
                    parsimony: float = 0.0005, max_samples: float = 0.9, seed: int = 0,
                    id_cols: Sequence[str] = ()):
    """Genetic search for a formula predicting ``target``.

    The driver keeps only formula trees (a population of a few thousand
    small tuples); every generation's fitness is one distributed pass
    (``fitness_numpy``).  Tournament selection, subtree crossover, subtree /
    hoist / point mutation as in common symbolic-regression tools; stops when
    the best raw error falls below ``stopping``.  Returns (best tree, raw
    mse, generation history [(generation, best_fitness, best_mse)]).
    """
    import random as _r
    from pyspark import StorageLevel
    rng = _r.Random(seed)
    functions = list(functions)
    # every generation reads the same rows: keep them cached for the search
    df = df.select(*dict.fromkeys([*features, target, *id_cols])).persist(StorageLevel.MEMORY_AND_DISK)
    pop = [_random_program(rng, rng.randint(*init_depth), features, const_range, functions)
           for _ in range(population)]
    try:
        return _search(df, pop, rng, target, features, generations, tournament, stopping, const_range, p_crossover,
                       p_subtree, p_hoist, p_point, functions, parsimony, max_samples, seed, id_cols)
    finally:
        df.unpersist()


def _search(df, pop, rng, target, features, generations, tournament, stopping, const_range, p_crossover,
            p_subtree, p_hoist, p_point, functions, parsimony, max_samples, seed, id_cols):
    population = len(pop)
    history = []
    best = None
    for gen in range(generations):
        fit = fitness_numpy(df, dict(enumerate(pop)), target, features, parsimony,
                            sample_frac=max_samples, seed=seed + gen, id_cols=id_cols)
        scored = [(fit[i][1], fit[i][0], pop[i]) for i in range(len(pop))]
        g_best = min(scored, key=lambda s: s[0])
        if best is None or g_best[0] < best[0]:
            best = g_best
        history.append((gen, float(g_best[0]), float(g_best[1])))
        if g_best[1] <= stopping or gen == generations - 1:
            break

        def pick():
            cand = [scored[rng.randrange(len(scored))] for _ in range(tournament)]
            return min(cand, key=lambda s: s[0])[2]

        nxt = []
        for _ in range(population):  # variation on the driver: trees only
            parent = pick()
            u = rng.random()
            if u < p_crossover:
                donor = pick()
                p1, _ = rng.choice(list(_nodes(parent)))
                _, sub = rng.choice(list(_nodes(donor)))
                child = _replace(parent, p1, sub)
            elif u < p_crossover + p_subtree:
                p1, _ = rng.choice(list(_nodes(parent)))
                child = _replace(parent, p1, _random_program(rng, 2, features, const_range, functions))
            elif u < p_crossover + p_subtree + p_hoist:
                _, sub = rng.choice(list(_nodes(parent)))
                child = sub
            elif u < p_crossover + p_subtree + p_hoist + p_point:
                p1, node = rng.choice(list(_nodes(parent)))
                if isinstance(node, tuple):
                    same = [f for f in functions if (f in ("sin", "cos")) == (node[0] in ("sin", "cos"))]
                    child = _replace(parent, p1, (rng.choice(same), *node[1:]))
                else:
                    child = _replace(parent, p1, _random_program(rng, 0, features, const_range, functions))
            else:
                child = parent
            nxt.append(child)
        pop = nxt
    return best[2], best[1], history


FORMULA_SCHEMA = "formula_id bigint, region string, expr string, length int"


def formula_rows(spark, found: dict) -> DataFrame:
    """{formula_id: (region, tree)} -> formula table rows."""
    return small_table(spark, [(int(i), r, render(t), int(length(t))) for i, (r, t) in found.items()],
                                 FORMULA_SCHEMA)


def save_formulas(rows: DataFrame, path: str) -> None:
    """Append found formulas to the formula table (Parquet)."""
    rows.write.mode("append").parquet(path)


def tournament_select(fit: DataFrame, n_slots: int, k: int, seed: int = 0,
                      id_col: str = "formula_id", score: str = "fitness") -> DataFrame:
    """Tournament selection as a Spark job: each of ``n_slots`` slots draws
    ``k`` contestants by a seeded draw of (slot, draw) and keeps the fittest.

    Contestants are addressed by their dense position in the population,
    so the draw is one equi-join, and the fan-out is exactly n_slots * k
    rows -- never all pairs.
    """
    spark = fit.sparkSession
    from pyspark.sql import Window

    from voxelframe.operators.ordinal import add_ordinal, numeric_split
    n = fit.count()
    # dense positions, numbered per id range (no single-task global window)
    pos = add_ordinal(fit, [], [id_col], "_pos", split_by=numeric_split(id_col, 100_000))
    draws = (spark.range(n_slots).withColumnRenamed("id", "slot")
                  .withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
                  .withColumn("_pos", F.pmod(draw(seed, F.col("slot"), F.col("draw")), F.lit(n))))
    j = draws.join(pos, "_pos")
    w = Window.partitionBy("slot").orderBy(F.col(score), F.col(id_col))
    return (j.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
             .select("slot", id_col, score))

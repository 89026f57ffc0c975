"""The cohort modelling job: region series -> 10-row rolling mean (full
windows) -> person label -> cohort -> train/test split -> scaler fitted on
train rows -> a linear model for every region from all the others -> R²,
MSE and MAE per cohort, region and split.

The prepared rows are written once as Parquet.  One pass over them gives the
shifted Gram matrix of every (cohort, split), from which the scaler, the
models of all regions, and their R² and MSE on train and test rows follow on
small matrices; a second pass sums the absolute errors.
"""

from __future__ import annotations

import uuid
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators import linear, windows
from voxelframe.operators.joins import label_lookup, route, unmatched
from voxelframe.operators.split import hash_split, sequential_split, split_by_key
from voxelframe.session import table_path
from voxelframe.tables import small_table


def prepare(regions: DataFrame, labels: DataFrame, scan: str, t: str, cols: Sequence[str],
            person: str, label_col: str, first_label: str, names=("men", "women"),
            window: int = 10, block: int | None = 65536, split: str = "sequential",
            test_frac: float = 0.3, checkpoint: bool = True, strict: bool = True) -> DataFrame:
    """Smoothed, labelled, split region rows.

    A person without a label is an error; with ``strict=False`` such rows are
    left out (``joins.unmatched`` lists the persons).

    With ``checkpoint`` the smoothed, labelled rows are written once as
    Parquet in the shared folder: the split's per-series counts and the model
    passes then read the columns they need instead of recomputing ordinals
    and windows, and a lost executor costs a re-read."""
    r = windows.rolling_mean(regions, [scan], t, list(cols), window=window, full_only=True, block=block)
    if strict and unmatched(regions, labels, person).limit(1).count():
        raise KeyError("persons without a label; see joins.unmatched")
    r = label_lookup(r, labels, person).withColumn(
        "cohort", route(F.col(label_col), first_label, names[0], names[1]))
    if checkpoint:
        path = table_path(regions.sparkSession, f"prepared_{uuid.uuid4().hex}")
        r.write.parquet(path)
        r = regions.sparkSession.read.schema(r.schema).parquet(path)
    if split == "sequential":
        return sequential_split(r, [scan], t, 1.0 - test_frac)
    if split == "person":
        return split_by_key(r, person, test_frac)
    return hash_split(r, [scan, t], test_frac)


class CohortModel:
    """Scaler and linear models of every region, from the train rows' count,
    sums and cross products of shifted values."""

    def __init__(self, n: int, gram: np.ndarray, shift: np.ndarray, method: str, alpha: float):
        total, cross = gram[-1, :-1], gram[:-1, :-1]
        self.mean = total / n
        cov = cross / n - np.outer(self.mean, self.mean)
        self.sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
        self.sd[self.sd <= 1e-12 * np.maximum(np.abs(self.mean + shift), 1e-300)] = 1.0
        cov = cov / np.outer(self.sd, self.sd)
        weights = linear.lasso_all_targets(cov, alpha) if method == "lasso" else linear.ols_all_targets(cov)
        # row k: the error of region k as a combination of standardised values
        self.error = np.eye(len(cov)) - weights

    def scores(self, n: int, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(R², MSE) of every region over the rows that ``gram`` sums."""
        total, cross = gram[-1, :-1], gram[:-1, :-1]
        z = (cross - np.outer(total, self.mean) - np.outer(self.mean, total) + n * np.outer(self.mean, self.mean))
        z = z / np.outer(self.sd, self.sd)
        sums = (total - n * self.mean) / self.sd
        sse = np.maximum(np.einsum("ki,ij,kj->k", self.error, z, self.error), 0.0)
        sst = np.diag(z) - sums * sums / n
        flat = sst <= 1e-12 * np.maximum(np.diag(z), 1e-300)
        r2 = np.where(flat, np.where(sse <= 1e-12 * n, 1.0, 0.0), 1.0 - sse / np.where(flat, 1.0, sst))
        return r2, sse / n


def _absolute_errors(batches, models, shift, cols):
    acc: dict = {}
    for pdf in batches:
        x = pdf[cols].to_numpy(dtype=np.float64) - shift
        for (cohort, split), at in pdf.groupby(["cohort", "split"]).indices.items():
            model = models.value[cohort]
            e = np.abs((x[at] - model.mean) / model.sd @ model.error.T).sum(axis=0)
            acc[(cohort, split)] = acc.get((cohort, split), 0.0) + e
    rows = [(c, s, r, float(v)) for (c, s), e in acc.items() for r, v in zip(cols, e)]
    yield pd.DataFrame(rows, columns=["cohort", "split", "region", "e"])


def cohort_scores(d: DataFrame, cols: Sequence[str], method: str = "ols", alpha: float = 0.001,
                  digits: int | None = None, max_cohorts: int = 1000) -> DataFrame:
    """(cohort, region, split, n, r2, mse, mae) for every region as target.

    Two passes over the prepared rows for all cohorts and regions together.
    Rows with a null region are left out.  More than ``max_cohorts`` cohorts
    raise."""
    cols = list(cols)
    spark = d.sparkSession
    d = d.select("cohort", "split", *cols).dropna(subset=["cohort", "split", *cols])
    first = d.first()
    schema = "cohort string, region string, split string, n bigint, r2 double, mse double, mae double"
    if first is None:
        return spark.createDataFrame([], schema)
    # values are summed relative to a row of the data, so squares stay on the scale of the spread
    shift = np.array([float(first[c]) for c in cols])
    shifted = d.select(F.to_json(F.array("cohort", "split")).alias("part"), F.lit(1.0).alias("_one"),
                       *[(F.col(c) - F.lit(float(v))).alias(c) for c, v in zip(cols, shift)])
    import json
    grams = {tuple(json.loads(k)): v for k, v in
             linear.gram_by(shifted, "part", [*cols, "_one"], max_groups=2 * max_cohorts).items()}
    models = {c: CohortModel(n, g, shift, method, alpha) for (c, s), (n, g) in grams.items() if s == "train"}
    # at most max_cohorts small matrices
    sent = spark.sparkContext.broadcast(models)

    def run(batches):
        return _absolute_errors(batches, sent, shift, cols)
    known = d.filter(F.col("cohort").isin(list(models)))
    errors = {(r["cohort"], r["split"], r["region"]): r["e"] for r in
              known.mapInPandas(run, "cohort string, split string, region string, e double")
              .groupBy("cohort", "split", "region").agg(F.sum("e").alias("e")).collect()}
    out = []
    for (cohort, split), (n, g) in grams.items():
        if cohort not in models:
            continue
        r2, mse = models[cohort].scores(n, g)
        for k, c in enumerate(cols):
            vals = [float(r2[k]), float(mse[k]), errors[(cohort, split, c)] / n]
            out.append((cohort, c, split, int(n), *[v if digits is None else float(round(v, digits)) for v in vals]))
    return small_table(spark, out, schema)

"""Command line for the batch jobs (runs under spark-submit as well).

  python -m voxelframe extract --worklist W --voxels V --atlas A --atlas-name N --out O
        [--confounds C] [--target hdd|runs|base] [--run NAME] [--no-standardize] [--detrend]
        [--max-per-person K] [--no-skip-existing]
  python -m voxelframe models --regions R --labels L --out O [--method ols|lasso]
        [--alpha 0.001] [--split sequential|person|random] [--test-frac 0.3]
  python -m voxelframe formulas --regions R --target x0 --out O [--population 1000]
        [--generations 150] [--tournament 20] [--seed 0]

``--regions`` is a Parquet region table (scan_id, person, t, x0..x{n-1});
``--labels`` a headered CSV (person, gender).  Options are plain arguments
(no INI files).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="voxelframe")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    e = sub.add_parser("extract")
    e.add_argument("--worklist", required=True)
    e.add_argument("--voxels", required=True)
    e.add_argument("--atlas", required=True)
    e.add_argument("--atlas-name", default="harvard_oxford")
    e.add_argument("--out", required=True)
    e.add_argument("--confounds")
    e.add_argument("--target", choices=["hdd", "runs", "base"], default="hdd")
    e.add_argument("--run", help="name of the run for --target runs")
    e.add_argument("--no-standardize", action="store_true")
    e.add_argument("--detrend", action="store_true")
    e.add_argument("--max-per-person", type=int)
    e.add_argument("--no-skip-existing", action="store_true")

    m = sub.add_parser("models")
    m.add_argument("--regions", required=True)
    m.add_argument("--labels", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--method", choices=["ols", "lasso"], default="ols")
    m.add_argument("--alpha", type=float, default=0.001)
    m.add_argument("--split", choices=["sequential", "person", "random"], default="sequential")
    m.add_argument("--test-frac", type=float, default=0.3)

    f = sub.add_parser("formulas")
    f.add_argument("--regions", required=True)
    f.add_argument("--target", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--population", type=int, default=1000)
    f.add_argument("--generations", type=int, default=150)
    f.add_argument("--tournament", type=int, default=20)
    f.add_argument("--seed", type=int, default=0)
    return p


def run(args: list[str], spark=None) -> None:
    a = _parser().parse_args(args)
    from voxelframe.session import build_session
    spark = spark or build_session(a.master)
    if a.cmd == "extract":
        from voxelframe.plans.extract import run_extraction
        s = run_extraction(spark, a.worklist, a.voxels, a.atlas, a.atlas_name, a.out, target=a.target,
                           confounds_path=a.confounds, skip_existing=not a.no_skip_existing,
                           standardize=not a.no_standardize, detrend=a.detrend,
                           max_per_person=a.max_per_person, run=a.run)
        print(f"extracted {s.count()} scans")
        return
    regions = spark.read.parquet(a.regions)
    cols = sorted([c for c in regions.columns if c.startswith("x") and c[1:].isdigit()], key=lambda c: int(c[1:]))
    if a.cmd == "models":
        from voxelframe.plans.modelling import cohort_scores, prepare
        from voxelframe.sources.files import read_labels
        d = prepare(regions, read_labels(spark, a.labels), "scan_id", "t", cols, "person", "gender", "M",
                    split=a.split, test_frac=a.test_frac)
        cohort_scores(d, cols, method=a.method, alpha=a.alpha).write.mode("overwrite").parquet(a.out)
        return
    if a.cmd == "formulas":
        from voxelframe.operators import formula
        feats = [c for c in cols if c != a.target]
        best, mse, hist = formula.symbolic_search(
            regions, a.target, feats, population=a.population, generations=a.generations,
            tournament=a.tournament, seed=a.seed, id_cols=["scan_id", "t"])
        rows = formula.formula_rows(spark, {0: (a.target, best)}).withColumn("mse", F.lit(float(mse)))
        formula.save_formulas(rows, a.out)


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()

"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely with the ``noop`` sink (no rows are
collected to the driver) after one warm-up query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from voxelframe.plans import catalog  # noqa: E402
from voxelframe.session import build_session  # noqa: E402

HEADLINE = [
    "cohort_rolling_mean", "rolling_mean_full", "zscore_series", "detrend_series",
    "region_mean_pivot", "extract_regions", "asof_last_event", "keyed_latest",
    "json_roundtrip", "describe_table", "regr_metrics", "score_matrix", "scale_features",
    "embedding_corr", "neighbour_smooth", "neighbour_smooth_long", "formula_fitness",
    "udf_grouped_map", "udf_cogroup_asof", "linear_fanout", "name_counter", "missing_region",
    "cohort_region_scores", "gbt_region", "net_train", "gbt_score_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = catalog.queries()
    qs["cohort_rolling_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Results do not depend on how the input is split or shuffled."""

import math

import pytest

import __spark_entry__ as se
from conftest import SF_SMALL

NAMES = ["rolling_mean_full", "cohort_rolling_mean", "asof_last_event", "udf_cogroup_asof", "extract_regions",
         "json_roundtrip", "csv_roundtrip", "seq_split", "row_by_position", "name_counter", "describe_table",
         "udf_grouped_map", "missing_region", "keyed_delete", "linear_fanout", "cohort_region_scores",
         "region_mean_pivot", "exact_split", "hash_split"]


def _rows(df):
    cols = sorted(df.columns)
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_split_and_partition_invariance(spark, name):
    q = se.queries()[name]
    base = _rows(q(spark, SF_SMALL))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions",
                                          "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        other = _rows(q(spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert other == base

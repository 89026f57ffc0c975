"""Every registered query runs on the smallest tables, and each query with
oracle SQL returns the same rows as DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from voxelframe.tables import TABLES

QUERIES = se.queries()
ORACLE = se.oracle_sql()


def test_contract():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 60


def test_entry(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert df.columns == ["cohort", "event_type", "mean_rm", "n"]
    assert len(rows) > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(r[i].isoformat() if hasattr(r[i], "isoformat") else r[i] for i in order))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def _same(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, (int, float)):
                if not (math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(x) and math.isnan(y))):
                    return False
            elif x != y:
                return False
    return True


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    if name not in ORACLE:
        assert len(df.columns) > 0
        return
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _same(_norm(rows, df.columns), _norm(cur.fetchall(), dcols))

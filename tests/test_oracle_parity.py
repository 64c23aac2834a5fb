"""Every registered key against its DuckDB oracle on the smallest test scale.

The driver runs the same comparison at sf0.01; this keeps it in the test
suite on sf0.001 so a regression shows up locally.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from fieldlens.oracle.queries import ORACLE  # noqa: E402
from fieldlens.plans.registry import REGISTRY  # noqa: E402
from compare_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
STREAMING = {k for k in REGISTRY if k.startswith("bronze_")}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_key_has_oracle():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "trigger" in df.columns


@pytest.mark.parametrize("key", sorted(k for k in REGISTRY if k not in STREAMING) + ["bronze_msl_interactions"])
def test_key_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    sc, sr = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    rel = con.sql(E.oracle_sql()[key])
    dc, dr = rows_of(rel.columns, rel.fetchall())
    assert sc == dc
    assert sr == dr

"""A sample of registered queries against their DuckDB SQL on the smallest tables
(the full set runs with scripts/check_oracles.py)."""

import os

import duckdb
import pytest

from conftest import SF001
from scripts.check_oracles import TABLES, rows_key
from tramflow.plans import catalog

SAMPLE = ["c1_delay_fact", "j9_nearest_stop_grid", "w6_previous_stops", "s10_sql_direction", "c5_route_variants_load",
          "c6_timetables_load", "w5_dense_ids", "a5_nested_routes", "x_text_blocks"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    q = catalog.REGISTRY[name]
    sdf = q.build(spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(q.sql)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert rows_key(srows, sdf.columns) == rows_key(drows, dcols)

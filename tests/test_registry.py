"""Every registered query against its oracle on the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

from tarmac.registry import ORACLES, QUERIES
from tarmac.registry.binding import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
NO_ORACLE = {"classify", "classify_metrics", "feature_importance"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def by_column(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_only_learned_models_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert by_column(df.columns, [tuple(r) for r in df.collect()]) == by_column(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_model_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0

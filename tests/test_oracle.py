"""Every registered query against its DuckDB oracle (sf0.001), or rows-only."""

import pytest

from conftest import SMALL

from __spark_entry__ import oracle_sql, queries
from shoplens.plans.queries import REGISTRY
from tools.oracle_check import duck, frame_digest

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SMALL).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = con.execute(sql).df()
    c1, n1, h1, r1 = frame_digest(got)
    c2, n2, h2, r2 = frame_digest(want)
    assert c1 == c2
    assert n1 == n2
    assert r1 == r2


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["area", "area_level", "pid", "city_infos", "click_count",
                          "product_name", "product_status"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(oracle_sql())


def test_the_oracle_stands_alone():
    """No constant or logic of the package decides what the statements expect."""
    import ast
    import oracle_statements
    tree = ast.parse(open(oracle_statements.__file__, encoding="utf-8").read())
    names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)]
    names += [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
    assert not [n for n in names if n.startswith("shoplens")]

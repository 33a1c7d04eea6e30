"""Every query against its SQL, at the smallest scale; the rest must run and give rows."""

import pytest

from logvigil.plans.catalog import ORACLE, QUERIES

from .oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) == ""
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)

"""Every registered query against its SQL counterpart, over whole tables."""

import os

import pytest
from conftest import DATA
from oracle_compare import compare, connect, row_work_outside_the_jvm_or_pairwise

from bayline.oracle import ORACLE
from bayline.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{DATA}/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert row_work_outside_the_jvm_or_pairwise(result) == []
    assert compare(result, duck, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert result.columns and result.count() > 0

"""Every registered query against its SQL counterpart; those without one must run and give rows."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as E


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(name, spark, sf_dir, con):
    result = E.queries()[name](spark, sf_dir)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert compare.difference(compare.spark_rows(result), compare.oracle_rows(con, sql)) is None


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 25
    changes = [r["change_4w"] for r in rows]
    assert changes == sorted(changes, reverse=True)

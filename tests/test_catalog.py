"""Every registered query with SQL agrees with DuckDB at the smallest scale."""

import pytest
from conftest import FOLDER

from cargolith import catalog
from compare import compare, oracle

QUERIES, SQL = catalog.load()


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["V03_payment_scoring", "S15_model_persistence", "R03_tuning", "R05_time_ordered_folds", "R06b_multiclass"])
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_names_are_paired():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) > 240


def test_entry_runs(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert {r.Season for r in rows} == {"Winter", "Spring", "Summer", "Fall"}

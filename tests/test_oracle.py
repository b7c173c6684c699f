"""Every registered query against its SQL counterpart on the smallest data set."""

import pytest

import __spark_entry__ as entry_points
from flowvigil.plans import catalogue
from compare import differences, duckdb_over

FOLDER = "/root/testdata/sf0.001"
ORACLE = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    frame = catalogue.queries()[name](spark, FOLDER).toPandas()
    assert differences(frame, duck.execute(ORACLE[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(ORACLE)))
def test_has_rows(spark, name):
    assert catalogue.queries()[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(catalogue.queries())

from __future__ import annotations

import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lotwise.checks import registry
from lotwise.checks.fixtures import ViewTables
from lotwise.plans import core
from lotwise.plans.core import RawTables

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(registry.REGISTRY) <= set(SQL)
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", registry.REGISTRY)
def test_query_gives_what_the_sql_gives(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, SQL[name]) == []


def test_joins_that_shuffle_give_the_same(shuffled_joins, con):
    for name in ("multiplex", "geocoded", "ward_bins"):
        assert differences(entry.queries()[name](shuffled_joins, SF_DIR), con, SQL[name]) == []


@pytest.mark.parametrize("parts", [1, 8])
def test_results_do_not_depend_on_the_order_of_the_input(spark, con, parts):
    given = ViewTables(spark, SF_DIR)
    names = ["permits", "address_points", "centreline", "city_wards", "labels"]
    shuffled = RawTables(**{n: getattr(given, n).repartition(parts, F.rand(parts)) for n in names})
    housing = registry.as_point(core.multiplex(core.permits_core(shuffled)))
    assert differences(housing, con, SQL["multiplex"]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0

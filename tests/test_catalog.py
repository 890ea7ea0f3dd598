"""Every named query against its check SQL on the smallest test tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import TESTDATA

import __spark_entry__ as driver
from paygrain.catalog.oracle import ORACLE
from paygrain.catalog.queries import REGISTRY

SMALL = str(TESTDATA / "sf0.001")
# On 145 rows a fit may rank by chance: the largest test table that stays quick.
FITTED = {"fraud_lr", "fraud_gbt"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(REGISTRY) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(set(ORACLE) - FITTED))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(driver.queries()[name](spark, SMALL), duck, ORACLE[name]) == []


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns[0] == "transaction_date" and frame.count() > 0


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_models(spark, name):
    larger = str(TESTDATA / "sf0.01")
    assert differences(driver.queries()[name](spark, larger), connect(larger), ORACLE[name]) == []

"""Every registered query against its SQL equivalent in a second engine."""

from __future__ import annotations

from functools import partial

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from courierlens.equivalents import EQUIVALENTS
from courierlens.plans import delay_model, demand_model
from courierlens.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """The facts that the learner queries return do not depend on the rounds; fewer spare minutes here."""
    with pytest.MonkeyPatch.context() as patch:
        for plan in (delay_model, demand_model):
            patch.setattr(plan, "train", partial(plan.train, rounds=8, depth=4))
        yield


@pytest.mark.parametrize("name", sorted(EQUIVALENTS))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    assert differences(df, duck, contract.oracle_sql()[name]) == []


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(EQUIVALENTS)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0

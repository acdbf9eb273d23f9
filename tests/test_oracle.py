"""Every query with an oracle gives the oracle's rows, names and types."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from workload.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, duck, sf_dir, name):
    problem, _ = compare(spark, duck, sf_dir, QUERIES[name], ORACLES[name])
    assert not problem


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_one_row_per_bucket(spark):
    assert {r["rating_category"] for r in contract.entry(spark).collect()} == {
        "High",
        "Medium",
        "Low",
    }

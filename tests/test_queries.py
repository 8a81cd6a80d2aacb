"""Every registered query against its SQL on a second engine, on the smallest tables."""

import pytest
from check_oracles import compare, duck
from conftest import SF

from indicata.standins.oracles import ORACLES
from indicata.standins.queries import REGISTRY


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, connection, name):
    outcome = compare(spark, connection, name, REGISTRY[name], ORACLES.get(name), SF)
    assert outcome.startswith("ok"), outcome
    assert "types" not in outcome, outcome


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)

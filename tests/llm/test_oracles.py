"""Registered queries against their SQL, and against plain Python where SQL has no words."""

import harness
import pytest

from claimlens.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return harness.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(work, con, name):
    assert harness.difference(queries.QUERIES[name](work, SF), con, queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op8_context_tree"}))
def test_every_row_is_answered(work, con, name):
    rows = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert queries.QUERIES[name](work, SF).count() == rows

"""The queries of this subpackage against their DuckDB oracles, at sf0.001."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_compare import SF, canon, connect  # noqa: E402

from lansight.llm.oracle import LLM_ORACLES  # noqa: E402
from lansight.llm.queries import LLM_QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return connect("documents", "conversations", "labels")


@pytest.mark.parametrize("key", list(LLM_ORACLES))
def test_query_matches_oracle(spark, con, key):
    spd = LLM_QUERIES[key](spark, SF).toPandas()
    opd = con.execute(LLM_ORACLES[key]).df()
    assert sorted(spd.columns) == sorted(opd.columns)
    assert canon(spd) == canon(opd)
    assert len(spd)

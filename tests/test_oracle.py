"""The driver's correctness gate, at sf0.001: every batch query of the core against its DuckDB oracle."""

from __future__ import annotations

import os

import pytest
from oracle_compare import SF, canon, connect

import __spark_entry__ as E
from lansight.oracle import ORACLES
from lansight.queries import QUERIES

SKIP_SLOW = ("stream_", "src_csv_stream", "sink_parquet")
KEYS = [k for k in ORACLES if not k.startswith(SKIP_SLOW)]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return connect("events")


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    spd = QUERIES[key](spark, SF).toPandas()
    opd = con.execute(ORACLES[key]).df()
    assert sorted(spd.columns) == sorted(opd.columns)
    assert canon(spd) == canon(opd)


@pytest.mark.parametrize("key", list(ORACLES))
def test_no_oracle_answer_is_empty(key):
    """At sf0.01 every detector has something to find."""
    if not os.path.isdir(SF.replace("0.001", "0.01")):
        pytest.skip("test tables not present")
    con = connect("events", sf=SF.replace("0.001", "0.01"))
    assert con.execute(f"SELECT count(*) FROM ({ORACLES[key]})").fetchone()[0] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["detector", "ts", "entity", "metric", "detail"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = {"mac_outliers"}  # clusters
    assert set(QUERIES) - set(ORACLES) == rows_only
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())

"""The registered queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import connect, differences
from panelyard.llm.oracle import ORACLE
from panelyard.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    assert not differences(spark, connect(sf), entry.queries()[name], entry.oracle_sql()[name], sf)


def test_all_thirteen_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())

"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from cartlake.catalog import ORACLES, QUERIES  # noqa: E402
from conftest import SF  # noqa: E402
from tools.check import compare  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, SF, name).startswith("ok")


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:2] == ["region", "local_date"]

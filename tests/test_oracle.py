"""Every registered query against its SQL on the smallest tables; ``check.py`` does larger ones.

The two long runs are left to ``check.py`` and to ``test_sources_and_jobs``.
"""

from __future__ import annotations

import pytest
from conftest import SF

import check
from tripmill.catalogue.entries import ORACLES, QUERIES

LONG = {"pipe_coldstart", "pipe_incremental"}


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in LONG])
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)

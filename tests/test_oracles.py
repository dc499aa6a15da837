"""Every registered query that has SQL against it, on the smallest tables."""

from pathlib import Path

import pytest

from checks.registry import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")


def test_registry():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 140


@pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")
@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, key):
    from checks.compare import compare, connect

    assert compare(spark, connect(str(DATA)), str(DATA), key) in ("", "equal but empty")

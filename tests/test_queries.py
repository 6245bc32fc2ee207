"""Every registered query against its SQL at the smallest scale, several at a time.

BLOCKSTRATA_SOME=n runs every n-th query only. tests/oracle.py runs all at any scale.
"""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

import oracle
from blockstrata.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)[::int(os.environ.get("BLOCKSTRATA_SOME", "1"))]


@pytest.fixture(scope="module")
def compared(spark):
    pool = ThreadPoolExecutor(6)
    yield {n: pool.submit(lambda n=n: oracle.compare(spark, oracle.connect(SF), SF, QUERIES[n], ORACLES[n])) for n in NAMES}
    pool.shutdown(cancel_futures=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(compared, name):
    differences, _ = compared[name].result()
    assert not differences


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL on the smallest tables. Queries run a few at a time."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from compare import difference, duck
from stratalake.queries.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def outcomes(spark, sf_dir):
    con = duck(sf_dir)

    def run(name):
        df = QUERIES[name](spark, sf_dir)
        if name in ORACLES:
            return difference(df, ORACLES[name], con.cursor())
        return None if df.columns and df.count() >= 0 else "no result"

    pool = ThreadPoolExecutor(6)
    yield {name: pool.submit(run, name) for name in QUERIES}
    pool.shutdown(cancel_futures=True)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(outcomes, name):
    assert outcomes[name].result(timeout=600) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) > 0.95 * len(QUERIES)

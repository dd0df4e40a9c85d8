"""Every query against its SQL on the smallest tables."""

import pytest
from oracle import connect, differences

from rivulet.plans.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
#: 400 training steps, a job each, whatever the size: compared by ``check_all.py``, and with numpy in ``test_numeric.py``.
LONG = "softmax_train_metrics"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", [key for key in QUERIES if key != LONG])
def test_query_matches_sql(spark, con, key):
    assert differences(QUERIES[key](spark, SF_DIR), con, ORACLES[key]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)

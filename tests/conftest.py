import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from paymart.session import local_session
    s = local_session("*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh_small(spark):
    from paymart.plans.warehouse import Warehouse
    return Warehouse.from_driver_tables(spark, SF_SMOKE)


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)

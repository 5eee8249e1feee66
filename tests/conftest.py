import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from flight_engine.session import get_spark
    # tests own no cluster; where spark.checkpoint.dir is unset, session.checkpoint_root makes a folder
    s = get_spark("tests", master="local[4]", shuffle_partitions=4)
    yield s
    SparkSession.getActiveSession() and s.stop()

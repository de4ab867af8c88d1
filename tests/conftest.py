import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from laminar.session import build_session
    extra = {}
    # Tests own their storage root only when the environment names none.
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="laminar-test-")
    s = build_session("local[*]", app_name="laminar-tests", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def area(spark):
    from laminar.session import new_area
    return new_area(spark, "test")

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusforge.session import get_spark
    s = get_spark("local[4]", app="corpusforge-tests", shuffle_partitions=4, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cf-test-ckpt-"),
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()

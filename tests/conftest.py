import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

LANDING = os.path.join(ROOT, "tests", "data", "landing")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[2]", shuffle_partitions=4, app="tidemark-tests",
                      extra={"spark.driver.memory": "4g", "spark.sql.adaptive.enabled": "true"})
    if not s.sparkContext.getCheckpointDir():  # tests only: the cluster sets its own
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from tidemark.session import work_dir
    return work_dir(spark, "test")

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from moldwise.session import get_spark

    s = get_spark("local[4]", 4, app_name="moldwise-tests",
                  extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt")),
                         "spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s
    s.stop()

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stockledger.config import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = tmp_path_factory.mktemp("ckpt")
    s = build_session(
        "local[*]",
        shuffle_partitions=8,
        app_name="stockledger-tests",
        extra={"spark.checkpoint.dir": str(ckpt), "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()

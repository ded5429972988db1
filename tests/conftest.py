import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = build_session(
        "local[4]",
        app_name="strata-tests",
        shuffle_partitions=4,
        warehouse=str(base / "warehouse"),
        conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    checkpoint_dir(s, str(base / "checkpoints"))
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)

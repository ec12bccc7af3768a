import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from matchday.session import build_session
    s = build_session("local[4]", app="matchday-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)

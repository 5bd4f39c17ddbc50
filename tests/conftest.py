import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from touchline.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()

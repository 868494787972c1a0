import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from care_episodes.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", shuffle_partitions=4, memory="4g", folder=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

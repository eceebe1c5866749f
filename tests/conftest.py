import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session

    session = local_session(cpus=4, checkpoints=str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()

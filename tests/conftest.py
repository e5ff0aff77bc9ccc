"""A small local session for all tests."""

import pytest

from tetraframe.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(4, 4, "3g")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

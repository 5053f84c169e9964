import pytest

from lathework.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "4g", "tests")
    yield s
    s.stop()

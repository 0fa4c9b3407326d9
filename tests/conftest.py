import pytest

from lakeworks.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL

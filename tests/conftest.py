import pytest

from ringspan.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="4g", name="ringspan-tests")
    yield session
    session.stop()

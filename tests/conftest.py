import pytest

from weekcast.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("weekcast-tests", spark__sql__maxMetadataStringLength="10000")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

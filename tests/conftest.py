import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

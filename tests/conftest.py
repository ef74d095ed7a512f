import pytest

from tablework.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tablework-tests", master="local[4]", cores=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

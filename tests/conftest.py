import pytest

from tests.parity import session


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)

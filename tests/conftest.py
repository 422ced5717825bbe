import pytest

from corpusloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, partitions=4, memory="6g")
    yield session
    session.stop()

import pytest

from lodestone.session import local_session, ship


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield ship(session)
    session.stop()

import pytest

from wellspring.session import local_session
from wellspring.workspace import ship_package


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", **{"spark.checkpoint.dir": shared})
    ship_package(session)
    yield session
    session.stop()

import pytest

from tests.session import session


@pytest.fixture(scope="session")
def spark():
    return session(memory="6g")


@pytest.fixture()
def store(spark, tmp_path):
    from freshet.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "tables"))

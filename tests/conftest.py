import pytest

from pulsegrid.session import clean_up, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests", **{"spark.sql.shuffle.partitions": "2"})
    yield session
    clean_up()
    session.stop()

import pytest

from tramline import build_session

TEST_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session("tramline-tests", "local[8]", **TEST_SETTINGS)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

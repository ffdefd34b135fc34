import pytest

from lexiloom.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    return s

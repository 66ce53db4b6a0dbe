import pytest

from ledgerline.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

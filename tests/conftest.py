import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fieldtally.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"
SF_CENTI = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def sf_centi():
    return SF_CENTI

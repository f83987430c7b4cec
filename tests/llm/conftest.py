import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def odd(spark):
    from fixtures import odd_pairs, table

    return table(spark, odd_pairs()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    from fixtures import table

    return table(spark, [])

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    from tallyloom.llm.common import find_package

    find_package(spark)

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clock import at  # noqa: E402

from tallyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "tests", spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")),
    )
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """``(key, value, ts)`` from texts, dicts or ``(value, seconds)`` pairs."""

    def build(*items, key=None):
        rows = []
        for item in items:
            value, seconds = item if isinstance(item, tuple) else (item, 0)
            text = value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)
            rows.append((key, text, at(seconds)))
        return spark.createDataFrame(rows, "key string, value string, ts timestamp")

    return build

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from medalytics import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    built = session.build(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()

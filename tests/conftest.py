import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kinmart.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")),
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, nulls first."""

    def read(df):
        key = lambda row: [(value is not None, str(value)) for value in row]
        return sorted((tuple(row) for row in df.collect()), key=key)

    return read

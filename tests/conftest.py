import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from almenara.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "almenara-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="4000",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="almenara-wh-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.01"

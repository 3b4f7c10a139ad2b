import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparloom.session import build

    session = build("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"

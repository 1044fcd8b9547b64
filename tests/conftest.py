from datetime import date

import pytest

from mensario.functions.period import Period
from mensario.session import local_session
from mensario.sources.lake import Lake

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def period():
    return Period(date(2024, 2, 1))


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))

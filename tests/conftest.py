import pytest

from quarry.session import build_session


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", shuffle_partitions=4, app="quarry-tests")

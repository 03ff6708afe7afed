import pytest

from terrace.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__checkpoint__dir=str(root / "shared"),
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="2000",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"

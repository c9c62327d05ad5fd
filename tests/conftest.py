import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = str(tmp_path_factory.mktemp("spark"))
    session = local_session(
        4,
        "tests",
        **{
            "spark.checkpoint.dir": work + "/shared",
            "spark.sql.warehouse.dir": work + "/warehouse",
            "spark.sql.shuffle.partitions": "3",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def work(tmp_path):
    return str(tmp_path)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerlane.session import local_session

    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        4,
        **{
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()

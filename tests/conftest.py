import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from revrank.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mini(spark):
    """3 users x 4 items: a repeated pair, a user without history, an unseen item, equal prices."""
    log = spark.createDataFrame(
        [
            (0, 0, 1.0, 1, 5.0), (0, 1, 0.0, 2, 3.0), (0, 0, 1.0, 3, 6.0), (0, 2, 1.0, 4, 2.0),
            (1, 0, 0.0, 1, 5.5), (1, 1, 1.0, 2, 3.5), (1, 0, 0.0, 5, 6.5),
        ],
        "user_idx bigint, item_idx bigint, relevance double, timestamp bigint, price double",
    )
    users = spark.createDataFrame([(0,), (1,), (2,)], "user_idx bigint")
    items = spark.createDataFrame([(0, 5.0), (1, 3.0), (2, 3.0), (3, None)], "item_idx bigint, price double")
    return log, users, items

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardwarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "cardwarden-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def setting(values):
        for key, value in values.items():
            saved.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield setting
    for key, value in saved.items():
        spark.conf.set(key, value)

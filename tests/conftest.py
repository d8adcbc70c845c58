from __future__ import annotations

import pytest

from docharbor.plans.dataset import Dataset
from docharbor.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests",
        cores="8",
        **{
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            # Small inputs: few tasks per job keep the tests short.
            "spark.sql.shuffle.partitions": "3",
            "spark.default.parallelism": "3",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def dataset(spark, tmp_path):
    made = Dataset(spark, str(tmp_path), "catalog")
    made.initialise()
    return made

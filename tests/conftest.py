import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8, 2, **{
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            # Many tiny plans: class compilation would take most of the time.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
        })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def entry():
    import importlib
    return importlib.import_module("__spark_entry__")

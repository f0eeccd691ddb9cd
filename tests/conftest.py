import os
import tempfile

import pytest

from dockflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="dockflow-tests-")
    session = build_session(
        "dockflow-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": os.path.join(work, "shared"),
            "spark.sql.warehouse.dir": os.path.join(work, "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

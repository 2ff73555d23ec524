from __future__ import annotations

import pytest

from pathquality.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        app="tests",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "4g",
            "spark.sql.codegen.wholeStage": "false",  # tiny inputs: compiling costs more
        },
    )
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()

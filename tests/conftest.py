import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for entry in (ROOT, os.path.join(ROOT, "tests")):
    sys.path.insert(0, entry)

from kinfold import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Every key with two rows counts as hot, so the salted paths run."""
    spark.conf.set("kinfold.hotRows", "2")
    yield
    spark.conf.unset("kinfold.hotRows")

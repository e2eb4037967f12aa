import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from foulee.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows to a DataFrame under a contract, missing trailing columns null."""

    def build(rows, schema):
        if isinstance(schema, str):
            return spark.createDataFrame(rows, schema)
        names = schema.fieldNames()
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)

    return build

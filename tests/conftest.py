import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from textmill.session import build_session

    session = build_session("tests", cpus="4", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate a column built from string inputs over a list of rows."""

    def run(build, rows, schema="x string"):
        df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
        got = df.select(build.alias("out")).collect()
        return [r["out"] for r in got]

    return run

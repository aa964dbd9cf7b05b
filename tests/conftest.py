import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from usagelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "usagelake-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            # Tiny frames: compiling a class per stage costs more than running it.
            "spark.sql.codegen.wholeStage": "false",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame("a int, b string", (1, "x"), ...) -> DataFrame"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

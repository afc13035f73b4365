import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lotlens.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "8", **{"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows(spark):
    """Collect expressions over literal rows: rows([("a",)], "c string", expr, ...)."""
    def run(data, schema, *exprs):
        return [tuple(r) for r in spark.createDataFrame(data, schema).select(*exprs).collect()]

    return run

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from tiermill.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "4g")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def rows(df, *cols):
    """Rows as sorted tuples."""
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def write(tmp_path):
    """Write a text file below the temporary folder and return its path."""

    def add(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return add


@pytest.fixture(scope="module")
def interpreted(spark):
    """Tiny fixtures with wide plans: compiling stages would take most of the time."""
    conf = {
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        "spark.sql.shuffle.partitions": "2",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    from checks.compare import session

    return session("4", **{"spark.checkpoint.dir": shared_folder})


@pytest.fixture
def write(tmp_path):
    """Write text files below the test's folder and return their paths."""

    def _write(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return _write


@pytest.fixture
def column(spark):
    """Values of a column expression over rows of one text column ``c``."""

    def _column(make, values, type_="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {type_}")
        return [r.out for r in df.select("i", make("c").alias("out")).orderBy("i").collect()]

    return _column

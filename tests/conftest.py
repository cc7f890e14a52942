import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, memory="4g", partitions=4, shared=shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of one expression over rows of text arguments."""
    from pyspark.sql import functions as F

    def run(expression, *rows, kinds=None):
        width = len(rows[0])
        kinds = kinds or ["string"] * width
        names = [f"a{i}" for i in range(width)]
        schema = ", ".join(["i int", *[f"{n} {k}" for n, k in zip(names, kinds)]])
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
        out = df.select("i", expression(*[F.col(n) for n in names]).alias("x")).orderBy("i")
        return [r["x"] for r in out.collect()]

    return run

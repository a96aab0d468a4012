from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gradus.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """The value of a column expression over a single row of inputs."""
    from pyspark.sql import functions as F

    def evaluate(build, *values):
        names = [f"c{i}" for i in range(len(values))]
        types = {str: "string", int: "bigint", float: "double", type(None): "string"}
        schema = ", ".join(
            f"{n} {types.get(type(v), 'array<string>')}" for n, v in zip(names, values, strict=True)
        )
        df = spark.createDataFrame([tuple(values)], schema)
        return df.select(build(*map(F.col, names)).alias("out")).first().out

    return evaluate

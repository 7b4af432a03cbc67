import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    SparkSession.builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    from chartloom.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate a column function on literal arguments."""
    from pyspark.sql import functions as F

    def run(fn, *args, types=None):
        kinds = types or ["string"] * len(args)
        names = [f"a{i}" for i in range(len(args))]
        schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
        df = spark.createDataFrame([tuple(args)], schema)
        return df.select(fn(*[F.col(n) for n in names]).alias("v")).first()["v"]

    return run

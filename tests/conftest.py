import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("rolelake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rolelake-ckpt-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over one literal text."""

    def evaluate(build, *texts):
        names = [f"c{i}" for i in range(len(texts))]
        schema = ", ".join(f"{n} string" for n in names) or "c0 string"
        df = spark.createDataFrame([texts or (None,)], schema).coalesce(1)
        return df.select(build(*names)).first()[0]

    return evaluate

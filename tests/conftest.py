import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from dialoom.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column_values(spark):
    """Values of a column function over texts, in order."""
    from pyspark.sql import functions as F

    def run(fn, texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
        return [row.v for row in df.select("i", fn(F.col("s")).alias("v")).orderBy("i").collect()]

    return run

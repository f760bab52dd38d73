import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tickflow.session import tune
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def ticks_of(spark):
    """Rows (symbol, price, microseconds since the epoch) as ticks."""
    from pyspark.sql import functions as F

    def make(rows, partitions=None):
        df = spark.createDataFrame(
            [(s, None if p is None else float(p), us) for s, p, us in rows], "symbol string, price double, us long")
        df = df.select("symbol", "price", F.timestamp_micros("us").alias("timestamp"))
        return df.repartition(partitions) if partitions else df
    return make

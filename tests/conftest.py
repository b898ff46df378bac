import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidegauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Build readings from (device, time text, temperature[, battery]) tuples."""
    from pyspark.sql import functions as F

    from tidegauge.functions.time import parse_iso

    def build(rows):
        rows = [tuple(r) + (50,) * (4 - len(r)) for r in rows]
        df = spark.createDataFrame(
            rows, "device_id string, timestamp string, temperature double, battery int"
        )
        return df.select(
            "device_id", "timestamp", "temperature", "battery",
            parse_iso("timestamp").alias("event_time"),
            (F.col("temperature") * 2).alias("humidity"),
            (F.col("temperature") + 1000).alias("pressure"),
            F.struct(F.lit(35.0).alias("lat"), F.lit(139.0).alias("lon")).alias("location"),
        )

    return build

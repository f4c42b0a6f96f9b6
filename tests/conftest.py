import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewatch.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    from tidewatch.sources.tables import read_events

    return read_events(spark, DATA)


@pytest.fixture
def make_events(spark):
    """Events from short tuples: second, user, type, page, device, session, amount."""
    from pyspark.sql import functions as F

    def build(rows, start="2024-01-01 00:00:00"):
        frame = spark.createDataFrame(
            [(str(i), *row) for i, row in enumerate(rows)],
            "event_id string, second double, user_id string, event_type string, page string, "
            "device string, session_id string, amount double",
        )
        moment = F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) + (F.col("second") * 1000000).cast("long"))
        return frame.withColumn("event_ts", moment).select(
            "event_id", "user_id", "event_type",
            F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
            "page", "session_id", "device", "amount", "event_ts",
            F.to_date("event_ts").alias("event_date"),
        )

    return build

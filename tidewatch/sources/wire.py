"""Keyed JSON rows, as a message topic carries them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import StreamConfig
from tidewatch.schema import EVENT_FIELDS, WIRE_SCHEMA


def kafka_options(config: StreamConfig) -> dict[str, str]:
    """Options of the topic source."""
    options = {
        "kafka.bootstrap.servers": config.brokers,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    if config.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    return options


def read_wire(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Wire rows from a topic or, with a file format, from stored ``key, value`` rows.

    For files ``maxFilesPerTrigger`` limits a micro-batch the way an offset cap does.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(WIRE_SCHEMA)
    return reader.load(path) if path else reader.load()


def source_stream(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """The stream a configuration describes."""
    options = dict(config.source_options)
    path = options.pop("path", None)
    if config.source_format == "kafka":
        options = {**kafka_options(config), **options}
    return read_wire(spark, config.source_format, options, path)


def encode_events(events: DataFrame, *kept: str) -> DataFrame:
    """Events as wire rows: the user as key, all fields as JSON with nulls written out; columns ``kept`` stay."""
    body = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    return events.select(
        F.col("user_id").cast("binary").alias("key"), body.cast("binary").alias("value"), *kept
    )


def write_wire(wire: DataFrame, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    """Publishes wire rows in one batch, to a topic or to files."""
    wire.write.format(fmt).options(**options).mode(mode).save()

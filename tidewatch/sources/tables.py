"""Stored tables: the raw events table and date-partitioned metric tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewatch.schema import INDEX_SCHEMA
from tidewatch.session import work_dir

# Columns and types of the raw events table.
RAW_EVENTS = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)

# Raw event type to event type.
TYPE_NAMES = {
    "view": "page_view",
    "click": "click",
    "purchase": "purchase",
    "signup": "search",
    "error": "add_to_cart",
}
PAGE_COUNT = 9
DEVICE_SHARES = ((11, "mobile"), (18, "desktop"), (20, "tablet"))


def raw_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The raw events table, as a table or as a stream of its files."""
    if not streaming:
        return spark.read.parquet(f"{sf_dir}/events.parquet")
    # A stream source wants a folder or a pattern; this pattern fits a file and a folder alike.
    return spark.readStream.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def canonical_events(raw: DataFrame) -> DataFrame:
    """Raw events in the event model: the eight wire fields plus time and date."""
    kind = F.col("event_type")
    names = F.coalesce(*(F.when(kind == source, target) for source, target in TYPE_NAMES.items()))
    event_ts = F.col("ts").cast("timestamp")
    user = F.concat(F.lit("u_"), F.col("user_id").cast("string"))
    slot = F.col("user_id") % DEVICE_SHARES[-1][0]
    device = F.lit(DEVICE_SHARES[-1][1])
    for bound, name in reversed(DEVICE_SHARES[:-1]):
        device = F.when(slot < bound, name).otherwise(device)
    number = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        user.alias("user_id"),
        names.alias("event_type"),
        F.date_format(event_ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        F.concat(F.lit("/p"), (number % PAGE_COUNT).cast("string")).alias("page"),
        F.concat(
            F.lit("s_"), F.col("user_id").cast("string"), F.lit("_"), F.date_format(event_ts, "yyyyMMddHH")
        ).alias("session_id"),
        device.alias("device"),
        F.when(kind == "purchase", F.col("value")).alias("amount"),
        event_ts.alias("event_ts"),
        F.to_date(event_ts).alias("event_date"),
    )


def read_events(
    spark: SparkSession,
    sf_dir: str,
    streaming: bool = False,
    kinds: tuple[str, ...] | None = None,
) -> DataFrame:
    """The events table in the event model.

    ``kinds`` keeps some event types only. The condition is put on the stored type, where the
    Parquet reader can use it.
    """
    raw = raw_events(spark, sf_dir, streaming)
    if kinds is not None:
        stored = [source for source, target in TYPE_NAMES.items() if target in kinds]
        raw = raw.filter(F.col("event_type").isin(stored))
    return canonical_events(raw)


def read_table(
    spark: SparkSession,
    path: str,
    since: Column | str | None = None,
    until: Column | str | None = None,
    fmt: str = "parquet",
    time: str = "window_start",
) -> DataFrame:
    """A stored table, optionally only the span [since, until).

    Tables are partitioned by ``event_date``; the span is given to the time column and to the
    partition column, so whole dates are skipped before any file is opened.
    """
    table = spark.read.format(fmt).load(path)
    partitioned = "event_date" in table.columns
    if since is not None:
        since = F.to_timestamp(F.lit(since)) if isinstance(since, str) else since
        table = table.filter(F.col(time) >= since)
        if partitioned:
            table = table.filter(F.col("event_date") >= F.to_date(since))
    if until is not None:
        until = F.to_timestamp(F.lit(until)) if isinstance(until, str) else until
        table = table.filter(F.col(time) < until)
        if partitioned:
            table = table.filter(F.col("event_date") <= F.to_date(until))
    return table


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A stored table, or no rows of that schema where nothing was written yet."""
    if path_exists(spark, path):
        return spark.read.format(fmt).schema(schema).load(path)
    return spark.createDataFrame([], schema)


def read_index(spark: SparkSession, path: str, schema: str = INDEX_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """An alert index, or the totals beside it, with the columns it was written with; where no alert was ever raised there are
    no files, and it has no rows of ``schema``."""
    if path_exists(spark, path):
        return spark.read.format(fmt).load(path)
    return spark.createDataFrame([], schema)


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = folder(spark, path)
    return files.exists(target)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and not empty."""
    files, target = folder(spark, path)
    return files.exists(target) and len(files.listStatus(target)) > 0


# Where the totals of an alert index stand.
TOTALS = "-totals"
# Where a streamed table's closed dates are copied to, and the pointer that says up to where.
CLOSED, FRONTIER = "-closed", "-frontier"
FRONTIER_SCHEMA = "version int, mark timestamp, until date"
FILE_TIME = "_metadata.file_modification_time"


def frontier(spark: SparkSession, path: str) -> Row | None:
    """The newest pointer of a table: how many copies hold, which files they cover (``mark``), and the dates below ``until``."""
    if not path_exists(spark, path + FRONTIER):
        return None
    return spark.read.schema(FRONTIER_SCHEMA).json(path + FRONTIER).orderBy(F.desc("version")).first()


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A streamed table: closed dates from their compacted copies, everything else from the files of the stream.

    Rows that came late for a closed date are in files younger than the pointer and are read from there until they are
    compacted too, so each row is read once at any time. The three parts are filtered by partition and by file time
    alone, so files that the copies cover are not opened.
    """
    streamed = spark.read.format(fmt).load(path)
    newest = frontier(spark, path)
    if newest is None:
        return streamed
    schema = streamed.schema
    copies = spark.read.format(fmt).schema(StructType([*schema.fields, StructField("run", IntegerType())])).load(path + CLOSED)
    closed = F.col("event_date").isNull() | (F.col("event_date") < F.lit(newest.until))
    late = streamed.filter(closed).filter(F.col(FILE_TIME) > F.lit(newest.mark))
    names = schema.fieldNames()
    return (
        copies.filter(F.col("run") <= newest.version).select(*names)
        .unionByName(streamed.filter(F.col("event_date") >= F.lit(newest.until)).select(*names))
        .unionByName(late.select(*names))
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a derived table once to the shared work folder and reads it back.

    For small tables that several branches of a plan read: without it each branch would
    compute them from the events again.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Work tables of one computation, in a folder of the shared one that is removed when it is done.

    ``with Scratch(spark, name) as scratch`` stores what later steps read again; what leaves the block has to be stored elsewhere.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = work_dir(spark, name)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table once and reads it back."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

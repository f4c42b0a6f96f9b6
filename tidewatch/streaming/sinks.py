"""Writers for batches and streams.

Replay safety: the file sink of Spark commits a micro-batch once. Writers called per
micro-batch put their rows under the batch id or merge them by key, so a repeated batch
replaces what its first attempt left. Failures are raised, never swallowed: the query stops
and resumes from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.upsert import newest_per_key, upsert
from tidewatch.sources.tables import CLOSED, FILE_TIME, FRONTIER, TOTALS, folder, frontier, path_exists


#: Formats of streamed tables that are written in zstd; wire rows are kept in them as texts.
PACKED = ("parquet", "orc")


def with_date(df: DataFrame, time: str = "window_start") -> DataFrame:
    """Adds the partition column ``event_date``."""
    return df if "event_date" in df.columns else df.withColumn("event_date", F.to_date(time))


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Adds the time a row was indexed."""
    return df.withColumn("indexed_at", F.current_timestamp() if at is None else at)


def append(df: DataFrame, path: str, partition_cols: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Appends a batch; with partition columns the rows are balanced over files first.

    The rebalance hint lets Spark split a date that holds most rows and join small ones.
    """
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    df.write.format(fmt).mode("append").partitionBy(*partition_cols).save(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines, one object per row, times as ISO text with offset."""
    (
        df.write.mode(mode)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def write_upsert(
    df: DataFrame,
    path: str,
    keys: list[str],
    staging: str,
    partition_cols: tuple[str, ...] = ("event_date",),
    order: list[Column] | None = None,
    fmt: str = "parquet",
) -> tuple | None:
    """Merges rows into a partitioned table by key; the smallest and largest value of the first partition column that it wrote, if any.

    Only partitions that receive rows are read and rewritten, so the partition columns must
    follow from the keys, as a date follows from a window.

    ``staging`` is a folder for this one write; a batch id belongs in its name. It first takes
    the new rows, so ``df`` is evaluated once, then the merged partitions, because a table
    cannot be overwritten while it is read. A write that is repeated after a failure finds
    complete stages there and goes on from them; merging the same rows again gives the same
    table. The folder is removed once the table is written.
    """
    spark = df.sparkSession
    fresh_path, merged_path = f"{staging}/fresh", f"{staging}/merged"
    if not path_exists(spark, f"{fresh_path}/_SUCCESS"):
        newest_per_key(df, keys, order).write.format(fmt).mode("overwrite").save(fresh_path)
    publish = fresh = spark.read.format(fmt).schema(df.schema).load(fresh_path)
    files, target = folder(spark, staging)
    first = F.col(partition_cols[0])
    low, high, rows = fresh.agg(F.min(first), F.max(first), F.count(F.lit(1))).first()
    if not rows:
        files.delete(target, True)
        return None
    if path_exists(spark, path):
        if not path_exists(spark, f"{merged_path}/_SUCCESS"):
            existing = spark.read.format(fmt).schema(df.schema).load(path).select(*df.columns)
            upsert(touched_partitions(existing, fresh, partition_cols), fresh, keys, order).write.format(fmt).mode("overwrite").save(merged_path)
        publish = spark.read.format(fmt).schema(df.schema).load(merged_path)
    _replace_partitions(publish, path, partition_cols, fmt)
    files.delete(target, True)
    return low, high


def touched_partitions(existing: DataFrame, fresh: DataFrame, partition_cols: tuple[str, ...]) -> DataFrame:
    """Rows of ``existing`` in partitions for which ``fresh`` has rows.

    The smallest and largest new values are looked up first, because only constants let the
    reader skip folders; the join then settles which partitions in between are meant.
    """
    bounds = fresh.agg(
        *(F.min(name).alias(f"low_{name}") for name in partition_cols),
        *(F.max(name).alias(f"high_{name}") for name in partition_cols),
    ).first()
    for name in partition_cols:
        within = F.col(name).between(F.lit(bounds[f"low_{name}"]), F.lit(bounds[f"high_{name}"]))
        existing = existing.filter(within | F.col(name).isNull())
    names = [f"_{name}" for name in partition_cols]
    touched = fresh.select(*(F.col(name).alias(f"_{name}") for name in partition_cols)).distinct()
    same = [F.col(name).eqNullSafe(F.col(other)) for name, other in zip(partition_cols, names)]
    return existing.join(touched, same, "left_semi")


def _replace_partitions(df: DataFrame, path: str, partition_cols: tuple[str, ...], fmt: str = "parquet") -> None:
    """Replaces exactly the partitions that ``df`` has rows for."""
    (
        df.hint("rebalance", *partition_cols)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .save(path)
    )


def index_alerts(
    alerts: DataFrame, path: str, staging: str, indexed_at: Column | None = None, fmt: str = "parquet"
) -> None:
    """Stores alerts under their id, the last write of an id winning, and renews the totals of the dates it touched.

    An alert that a stream takes back stays in the table, as ``withdrawn``; readers of alerts pass it over.
    """
    spark = alerts.sparkSession
    touched = write_upsert(stamp(with_date(alerts), indexed_at), path, ["alert_id"], staging, fmt=fmt)
    if touched:
        refresh_totals(spark, path, *touched, fmt=fmt)


def refresh_totals(spark: SparkSession, path: str, low, high, fmt: str = "parquet") -> None:
    """Counts the alerts of some dates anew: per date, series, severity and type, with the oldest and newest time of indexing.

    A small table beside the alerts that searches and reports read first. Only the dates between ``low`` and ``high`` are read; a count that is
    made again is the same, so a repeated batch changes nothing.
    """
    alerts = spark.read.format(fmt).load(path).filter(F.col("event_date").between(F.lit(low), F.lit(high)))
    holds = ~F.col("withdrawn") if "withdrawn" in alerts.columns else F.lit(True)
    # A date whose alerts were all withdrawn keeps rows that count none, so that its partition is replaced too.
    kinds = [name for name in ("series", "severity", "alert_type") if name in alerts.columns]
    totals = alerts.groupBy("event_date", *kinds).agg(
        F.count_if(holds).alias("alerts"), F.min("indexed_at").alias("oldest"), F.max("indexed_at").alias("newest")
    )
    _replace_partitions(totals, path + TOTALS, ("event_date",), fmt)


def index_metrics(metrics: DataFrame, path: str, indexed_at: Column | None = None) -> None:
    """Appends metric rows with the time they were indexed."""
    append(stamp(with_date(metrics), indexed_at), path, ("event_date",))


def _trigger(seconds: int | None) -> dict:
    return {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    seconds: int | None = None,
    partition_cols: tuple[str, ...] = (),
    fmt: str = "parquet",
    name: str | None = None,
    files: int | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Appends a stream to a table; without ``seconds`` it works off what is there and ends.

    Files older than ``retention`` leave the sink's log, so that it stays short; give it only where
    ``compact_closed`` has copied them by then.

    ``files`` limits the files of a micro-batch, for results that are small by nature or
    triggers that are short. The rows are shuffled for it; the tasks before keep their number.
    """
    writer = (
        (df.repartition(files) if files else df).writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(seconds))
    )
    if fmt in PACKED:
        writer = writer.option("compression", "zstd")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if retention:
        writer = writer.option("retention", retention)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_publish(
    wire: DataFrame, fmt: str, options: dict[str, str], checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Publishes encoded events to a topic (``kafka``) or to files as they arrive."""
    return (
        wire.writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(seconds))
        .queryName("publish")
        .start()
    )


def start_batches(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    seconds: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hands every micro-batch to ``handle(batch, batch_id)``."""
    writer = (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(seconds))
        .foreachBatch(handle)
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_archive(
    events: DataFrame, path: str, checkpoint: str, seconds: int | None = None, files: int | None = None,
    fmt: str = "parquet", name: str = "raw", partition_cols: tuple[str, ...] = ("event_date",), retention: str | None = None,
) -> StreamingQuery:
    """Lands parsed events, one folder per date; events without a date have their own."""
    return start_append(events, path, checkpoint, seconds, partition_cols, fmt, name=name, files=files, retention=retention)


def compact_dates(
    spark: SparkSession, path: str, out: str, until: str, since: str | None = None, fmt: str = "parquet"
) -> None:
    """Copies the closed dates of a table, [since, until), into ``out`` with few files for each date.

    A streamed table keeps its own files, which its sink's log names; readers of old dates turn to the copy. Dates that the copy has are replaced.
    """
    table = spark.read.format(fmt).load(path).filter(F.col("event_date") < F.lit(until).cast("date"))
    if since is not None:
        table = table.filter(F.col("event_date") >= F.lit(since).cast("date"))
    _replace_partitions(table, out, ("event_date",), fmt)


def compact_closed(spark: SparkSession, path: str, until, fmt: str = "parquet", partition_cols: tuple[str, ...] = ("event_date",)) -> None:
    """Copies what a streamed table has for dates before ``until``, and without a date, and moves the pointer; for tables that no query is writing to.

    A copy holds what no earlier one has: closed dates that were open then, and rows that came late for older ones, told by the time of their files. It is written
    whole before the pointer names it, and never changed, so a reader sees either state; a run that failed is repeated with the same
    result. ``read_current`` reads copies and stream as one table.
    """
    if not path_exists(spark, path):
        return
    table = spark.read.format(fmt).load(path)
    before = frontier(spark, path)
    date, written = F.col("event_date"), F.col(FILE_TIME)
    mark = table.agg(F.max(written)).first()[0]
    if mark is None or (before and before.until >= until and before.mark >= mark):
        return
    version, wanted = 1, date.isNull() | (date < F.lit(until))
    if before:
        version, until = before.version + 1, max(until, before.until)
        wanted = (date >= F.lit(before.until)) & (date < F.lit(until)) | (
            (date.isNull() | (date < F.lit(before.until))) & (written > F.lit(before.mark))
        )
    rows = table.filter(wanted).hint("rebalance", *partition_cols)
    rows.write.format(fmt).mode("overwrite").partitionBy(*partition_cols).save(f"{path}{CLOSED}/run={version}")
    pointer = spark.createDataFrame([(version, mark, until)], "version int, mark timestamp, until date")
    pointer.coalesce(1).write.mode("append").json(path + FRONTIER)


def start_alert_index(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    seconds: int | None = None,
    report: Callable[[int], None] | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Indexes streamed alerts by id; ``report`` is told the id of every finished batch."""

    def index(batch: DataFrame, batch_id: int) -> None:
        index_alerts(batch, path, f"{checkpoint}/staging/{batch_id}", fmt=fmt)
        if report:
            report(batch_id)

    return start_batches(alerts, index, checkpoint, seconds, name="alerts")

"""Ready-made queries over the events table, each ``(spark, sf_dir) -> DataFrame``.

All of them read the whole table. Window starts leave as zone-less timestamps in UTC.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.config import StreamConfig, WindowConfig
from tidewatch.functions.measures import revenue_parts, whole_cents
from tidewatch.operators import anomalies, quality, serving, windows
from tidewatch.operators.dedupe import deduplicate, with_delay
from tidewatch.operators.parse import EVENT, landed_rows, landing, parse_events, reject_counts, split_valid
from tidewatch.operators.series import fill_gaps, with_series
from tidewatch.operators.upsert import upsert
from tidewatch.schema import EVENT_FIELDS, LANDED_SCHEMA
from tidewatch.session import prepare, state_partitions, work_dir
from tidewatch.sources.tables import CLOSED, path_exists, raw_events, read_current, read_events, read_index, read_table, stored
from tidewatch.sources.wire import encode_events, write_wire, read_wire
from tidewatch.streaming import corrections, sinks
from tidewatch.streaming.baseline import detect_stream
from tidewatch.streaming.job import clean_events, start_all

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Registers a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(build(prepare(spark), sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    REGISTRY[build.__name__] = run
    return run


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values without a zone."""
    stamps = {name for name, kind in df.dtypes if kind == "timestamp"}
    return df.select(
        *(F.col(name).cast("timestamp_ntz").alias(name) if name in stamps else F.col(name) for name in df.columns)
    )


# ---------------------------------------------------------------- sources and parsing


def damaged_wire(events: DataFrame, *kept: str) -> DataFrame:
    """The wire form of every event four times: intact, cut off, with an unreadable time and without user; columns ``kept`` stay."""
    forms = F.explode(F.array(*map(F.lit, ("whole", "broken", "undated", "anonymous")))).alias("form")
    copies = events.select("*", forms)
    form = F.col("form")
    changed = copies.withColumn(
        "timestamp", F.when(form == "undated", "not a time").otherwise(F.col("timestamp"))
    ).withColumn("user_id", F.when(form != "anonymous", F.col("user_id")))
    cut_off = F.expr("left(string(value), length(string(value)) - 1)").cast("binary")
    value = F.when(form == "broken", cut_off).otherwise(F.col("value")).alias("value")
    return encode_events(changed, "form", *kept).select("key", value, *kept)


@query
def parse_roundtrip(spark, sf_dir):
    """Encode, damage and decode; usable events come back field by field."""
    return parse_events(damaged_wire(read_events(spark, sf_dir)))


@query
def wire_encode(spark, sf_dir):
    """Keyed wire rows, read back with a JSON path per field."""
    wire = encode_events(read_events(spark, sf_dir))
    text = F.col("value").cast("string")
    fields = F.json_tuple(text, *EVENT_FIELDS).alias(*EVENT_FIELDS)
    return wire.select(
        F.col("key").cast("string").alias("key"),
        fields,
        text.contains('"amount":').alias("has_amount_field"),
    ).withColumn("amount", F.col("amount").cast("double"))


@query
def wire_files(spark, sf_dir):
    """Wire rows published to files and read back as a batch."""
    path = work_dir(spark, "wire")
    write_wire(encode_events(read_events(spark, sf_dir)), "parquet", {"path": path})
    return parse_events(read_wire(spark, "parquet", path=path, streaming=False)).drop("timestamp")


@query
def count_rejects(spark, sf_dir):
    """Usable, rejected and undated wire rows in one pass."""
    return reject_counts(damaged_wire(read_events(spark, sf_dir)))


@query
def rejected_rows(spark, sf_dir):
    """The rejected side of the split: what is left of rows without event or user id."""
    _, rejected = split_valid(damaged_wire(read_events(spark, sf_dir)))
    return rejected.groupBy("event_type").agg(F.count(F.lit(1)).alias("rejected"))


@query
def dedupe_events(spark, sf_dir):
    """Every event with a copy one second later on another page and an exact copy."""
    events = read_events(spark, sf_dir).drop("timestamp")
    later = events.withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 1 SECOND")).withColumn(
        "page", F.lit("/copy")
    )
    return deduplicate(later.unionByName(events).unionByName(events))


@query
def event_contract(spark, sf_dir):
    """Contract violations per rule among the usable rows of the damaged wire."""
    return quality.check_contract(parse_events(damaged_wire(read_events(spark, sf_dir))))


# ---------------------------------------------------------------- window metrics


@query
def metrics_tumbling(spark, sf_dir):
    """One-minute metrics."""
    return windows.tumbling_metrics(read_events(spark, sf_dir))


@query
def metrics_bad_amounts(spark, sf_dir):
    """Hourly metrics from a wire on which amounts are NaN, infinite, huge or below a cent."""
    turn = F.col("event_id").cast("long") % 7
    amount = F.col("amount")
    spoilt = (
        F.when(turn == 0, F.lit(float("nan"))).when(turn == 1, F.lit(float("inf"))).when(turn == 2, F.lit(1e300))
        .when(turn == 3, F.lit(0.004)).otherwise(amount)
    )
    events = read_events(spark, sf_dir).withColumn("amount", F.when(amount.isNotNull(), spoilt))
    return windows.tumbling_metrics(parse_events(encode_events(events)), "1 hour")


@query
def metrics_hourly(spark, sf_dir):
    """The same metrics per hour, from the wire through parsing and deduplication."""
    wire = encode_events(read_events(spark, sf_dir))
    return windows.tumbling_metrics(deduplicate(parse_events(wire)), "1 hour")


@query
def daily_from_minutes(spark, sf_dir):
    """Daily metrics per device rolled up from stored minute rows; users and sessions, estimates, stand as within a twentieth of the exact number."""
    events = read_events(spark, sf_dir)
    minutes = stored(windows.sketched_metrics(events, keys=("device",)), "minutes")
    days = windows.roll_up(minutes, "1 day", ("device",))
    exact = events.groupBy(F.window("event_ts", "1 day")["start"].alias("window_start"), "device").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("session_id").alias("sessions")
    )
    near = [(F.abs(F.col(a) - F.col(b)) <= 1 + 0.05 * F.col(b)).alias(f"{b}_near") for a, b in (("unique_users", "users"), ("unique_sessions", "sessions"))]
    return days.join(exact, ["window_start", "device"]).select(
        "window_start", "device", "total_events", "purchase_count", "total_revenue", "users", "sessions", *near
    )


@query
def metrics_sliding(spark, sf_dir):
    """Five-minute metrics every 30 seconds."""
    return windows.sliding_metrics(read_events(spark, sf_dir))


@query
def metrics_sliding_long(spark, sf_dir):
    """One-hour metrics every 30 seconds: 120 windows hold each event."""
    return windows.sliding_metrics(read_events(spark, sf_dir), "1 hour", "30 seconds")


@query
def top_pages(spark, sf_dir):
    """The three most viewed pages of every hour."""
    return windows.top_pages(read_events(spark, sf_dir, kinds=("page_view",)), 3, "1 hour")


@query
def page_counts(spark, sf_dir):
    """Views of every page per minute."""
    return windows.page_counts(read_events(spark, sf_dir, kinds=("page_view",)))


@query
def device_breakdown(spark, sf_dir):
    """Events and users per device and hour."""
    return windows.device_breakdown(read_events(spark, sf_dir), "1 hour")


@query
def revenue_by_window(spark, sf_dir):
    """Purchases per hour."""
    return windows.revenue(read_events(spark, sf_dir, kinds=("purchase",)), "1 hour")


# ---------------------------------------------------------------- anomalies

QUIET, BUSY = "10 minutes", "1 hour"


def detector_input(spark: SparkSession, sf_dir: str, width: str, *keys: str) -> DataFrame:
    """Stored window metrics for the detector, per key if there are any."""
    return stored(windows.traffic(read_events(spark, sf_dir), width, keys), "metrics")


def _alerts(spark, sf_dir, width: str, *kinds: str, keys: tuple[str, ...] = ()) -> DataFrame:
    found = anomalies.detect(
        detector_input(spark, sf_dir, width, *keys), width, keys=keys, detected_at=F.col("window_end")
    )
    return found.filter(F.col("alert_type").isin(*kinds)) if kinds else found


@query
def window_spine(spark, sf_dir):
    """Ten-minute windows without holes."""
    filled = fill_gaps(with_series(detector_input(spark, sf_dir, QUIET)), QUIET)
    return filled.select("series", "window_start", "window_no", "event_count", "revenue", "active_users")


@query
def rolling_baseline(spark, sf_dir):
    """Samples, mean, deviation, z-score and change of every window against the 20 before."""
    rows = anomalies.statistics(anomalies.baseline_table(detector_input(spark, sf_dir, QUIET), QUIET))
    measured = {"mean", "std", "z", "pct"}
    return rows.select(
        *(F.round(name, 6).alias(name) if name.split("_")[-1] in measured else F.col(name) for name in rows.columns)
    )


@query
def alerts_spike_drop(spark, sf_dir):
    """Traffic spikes and drops per ten minutes."""
    return _alerts(spark, sf_dir, QUIET, "spike", "drop")


@query
def alerts_revenue(spark, sf_dir):
    """Revenue drops per hour."""
    return _alerts(spark, sf_dir, BUSY, "revenue_drop")


@query
def alerts_zero(spark, sf_dir):
    """Ten-minute windows without any event."""
    return _alerts(spark, sf_dir, QUIET, "zero_events")


@query
def alerts_by_device(spark, sf_dir):
    """All rules, one series per device, per hour."""
    return _alerts(spark, sf_dir, BUSY, keys=("device",))


@query
def alerts_by_device_page(spark, sf_dir):
    """All rules, a series per device and page per hour; keys with the separator, a null and a text that looks like none."""
    spelled = (
        F.when(F.col("page") == "/p0", F.lit(None)).when(F.col("page") == "/p1", "(none)")
        .when(F.col("page") == "/p2", "a|b").when(F.col("page") == "/p3", "b").otherwise("c\\d")
    )
    device = F.when((F.col("device") == "tablet") & (F.col("page") == "/p3"), "tablet|a").otherwise(F.col("device"))
    events = read_events(spark, sf_dir).withColumn("device", device).withColumn("page", spelled)
    table = stored(windows.traffic(events, BUSY, ("device", "page")), "metrics")
    return anomalies.detect(table, BUSY, keys=("device", "page"), detected_at=F.col("window_end"))


@query
def alerts_sliding(spark, sf_dir):
    """All rules over five-minute windows every 30 seconds."""
    metrics = windows.sliding_metrics(read_events(spark, sf_dir))
    table = stored(metrics.select("window_start", "event_count", "revenue", "active_users"), "metrics")
    return anomalies.detect(table, "30 seconds", "5 minutes", detected_at=F.col("window_end"))


@query
def series_segments(spark, sf_dir):
    """All rules over ten-minute windows, with the first two days once more 19,000 days earlier: two segments, not the years between."""
    events = read_events(spark, sf_dir)
    first = events.agg(F.min("event_ts")).first()[0]
    early = events.filter(F.col("event_ts") < F.lit(first) + F.expr("INTERVAL 2 DAYS"))
    moved = events.unionByName(early.withColumn("event_ts", F.col("event_ts") - F.expr("INTERVAL 19000 DAYS")))
    table = stored(windows.traffic(moved, QUIET), "metrics")
    return anomalies.detect(table, QUIET, detected_at=F.col("window_end"))


@query
def detector_summary(spark, sf_dir):
    """Windows, alerts and last baselines of the hourly device series."""
    return anomalies.summary(detector_input(spark, sf_dir, BUSY, "device"), BUSY, ("device",))


# ---------------------------------------------------------------- tables and sinks


def _device_tables(spark, sf_dir):
    """Hourly device rows of page views, and of purchases as the newer version."""
    old = windows.device_breakdown(read_events(spark, sf_dir, kinds=("page_view",)), "1 hour")
    new = windows.device_breakdown(read_events(spark, sf_dir, kinds=("purchase",)), "1 hour")
    return old, new


@query
def upsert_metrics(spark, sf_dir):
    """Hourly device rows of page views, replaced where there were purchases."""
    old, new = _device_tables(spark, sf_dir)
    return upsert(old, new, ["window_start", "device"])


@query
def upsert_table(spark, sf_dir):
    """The same as two merges into a date-partitioned table."""
    path = work_dir(spark, "devices")
    for place, part in enumerate(_device_tables(spark, sf_dir)):
        sinks.write_upsert(
            sinks.with_date(part), path, ["window_start", "device"], work_dir(spark, f"staging-{place}")
        )
    return spark.read.parquet(path)


@query
def append_table(spark, sf_dir):
    """Hourly revenue appended to a date-partitioned table and read back."""
    return read_table(spark, _revenue_table(spark, sf_dir))


@query
def table_span(spark, sf_dir):
    """A time span of the stored hourly revenue; other dates are skipped unread."""
    path = _revenue_table(spark, sf_dir)
    return read_table(spark, path, since="2024-01-08 06:00:00", until="2024-01-15")


def _revenue_table(spark, sf_dir) -> str:
    path = work_dir(spark, "revenue")
    table = windows.revenue(read_events(spark, sf_dir, kinds=("purchase",)), "1 hour")
    sinks.append(sinks.with_date(table), path, ("event_date",))
    return path


@query
def json_lines(spark, sf_dir):
    """Hourly metrics written as JSON lines and read back."""
    path = work_dir(spark, "json")
    metrics = windows.tumbling_metrics(read_events(spark, sf_dir), "1 hour")
    sinks.write_json(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


def indexed_alerts(spark, sf_dir) -> DataFrame:
    """The alert index: hourly device alerts, indexed twice at their window's end."""
    path = work_dir(spark, "alerts")
    alerts = stored(_alerts(spark, sf_dir, BUSY, keys=("device",)), "alerts")
    for attempt in range(2):
        sinks.index_alerts(alerts, path, work_dir(spark, f"staging-{attempt}"), F.col("window_end"))
    return read_index(spark, path)


@query
def alert_index(spark, sf_dir):
    """Alerts stored under their id; a second delivery changes nothing."""
    return indexed_alerts(spark, sf_dir)


@query
def metrics_index(spark, sf_dir):
    """Hourly device metrics appended with the time they were indexed."""
    path = work_dir(spark, "metrics-index")
    metrics = windows.device_breakdown(read_events(spark, sf_dir), "1 hour")
    sinks.index_metrics(metrics, path, F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    return spark.read.parquet(path)


# ---------------------------------------------------------------- serving


def _hourly(spark, sf_dir):
    """Hourly metrics as a stored table with a folder for each date, as the job leaves them."""
    return _dated(windows.tumbling_metrics(read_events(spark, sf_dir), "1 hour"), "hourly")


def _hourly_pages(spark, sf_dir):
    return _dated(windows.page_counts(read_events(spark, sf_dir, kinds=("page_view",)), "1 hour"), "pages")


def _dated(table: DataFrame, name: str) -> DataFrame:
    path = work_dir(table.sparkSession, name)
    sinks.append(sinks.with_date(table), path, ("event_date",))
    return read_table(table.sparkSession, path)


@query
def latest_metrics(spark, sf_dir):
    """The 100 newest hours of the stored table."""
    return serving.newest(_hourly(spark, sf_dir)).drop("event_date")


@query
def metrics_history(spark, sf_dir):
    """The 60 newest hours in time order."""
    return serving.history(serving.newest(_hourly(spark, sf_dir), 60)).drop("event_date")


@query
def latest_pages(spark, sf_dir):
    """The 20 newest page rows."""
    return serving.newest(_hourly_pages(spark, sf_dir), 20).drop("event_date")


@query
def kpi_latest(spark, sf_dir):
    """Status row of the newest hour."""
    return serving.kpis(serving.newest(_hourly(spark, sf_dir), 2))


@query
def type_breakdown(spark, sf_dir):
    """Views, clicks and searches of the 60 newest hours."""
    return serving.type_breakdown(serving.newest(_hourly(spark, sf_dir), 60))


@query
def top5_share(spark, sf_dir):
    """The five most viewed pages of all hours with their bars."""
    return serving.page_share(_hourly_pages(spark, sf_dir))


def _quiet_index(spark, sf_dir) -> str:
    """The index of all ten-minute alerts, stamped with their window's end."""
    path = work_dir(spark, "alert-index")
    sinks.index_alerts(_alerts(spark, sf_dir, QUIET), path, work_dir(spark, "staging"), F.col("window_end"))
    return path


@query
def alert_search(spark, sf_dir):
    """The 20 newest critical drops of the stored index."""
    return serving.search_index(spark, _quiet_index(spark, sf_dir), "critical", "drop").drop("event_date")


@query
def recent_alerts(spark, sf_dir):
    """The five alerts of the status panel, from the stored index."""
    return serving.recent_alerts(serving.search_index(spark, _quiet_index(spark, sf_dir), n=10))


# ---------------------------------------------------------------- streams


def _streamed(spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs the events table through the wire form as a stream into a table."""
    wire = encode_events(read_events(spark, sf_dir, streaming=True))
    return _drained(spark, sf_dir, build(clean_events(wire, StreamConfig())))


def _drained(spark: SparkSession, sf_dir: str, stream: DataFrame) -> DataFrame:
    path = work_dir(spark, "stream")
    with state_partitions(spark, _state_count(spark, sf_dir)):
        started = sinks.start_append(stream, path, work_dir(spark, "checkpoint"))
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


PARTS = 4


def timed_part(events: DataFrame) -> DataFrame:
    """Events with the quarter of the whole time span, 0 to 3, that they fall into."""
    low, high = events.agg(F.min(F.unix_micros("event_ts")), F.max(F.unix_micros("event_ts"))).first()
    place = F.floor((F.unix_micros("event_ts") - low) * PARTS / (high - low + 1))
    return events.withColumn("part", F.least(place, F.lit(PARTS - 1))).withColumn("first_hour", F.unix_micros("event_ts") < low + 3_600_000_000)


#: Wire files of a micro-batch, however many events there are: with them as ``maxFilesPerTrigger`` each part is one micro-batch.
PART_FILES = 4


def write_part(wire: DataFrame, path: str) -> None:
    """The files of one micro-batch of wire rows."""
    write_wire(wire.repartition(PART_FILES, F.xxhash64("key", "value")), "parquet", {"path": path})


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return read_wire(spark, "parquet", {"maxFilesPerTrigger": str(PART_FILES)}, path)


def batched_wire(spark: SparkSession, sf_dir: str) -> str:
    """Wire files of the events table in time order, and a last one of odd rows.

    The odd rows: a copy of each event of the first hour, one event in the year 2100, and a broken row for each event on page ``/p1``.
    """
    events = timed_part(read_events(spark, sf_dir))
    path = work_dir(spark, "batched-wire")
    for place in range(PARTS):
        write_part(encode_events(events.filter(F.col("part") == place)), path)
    future = events.orderBy("event_id").limit(1).withColumns(
        {"event_id": F.lit("future"), "timestamp": F.lit("2100-01-01T00:00:00+00:00")}
    )
    broken = encode_events(events.filter(F.col("page") == "/p1")).withColumn("value", F.lit("{").cast("binary"))
    odd = encode_events(events.filter("first_hour").unionByName(future)).unionByName(broken)
    write_part(odd, path)
    return path


@query
def stream_late(spark, sf_dir):
    """Five micro-batches straight into hourly windows: rows that come when their hour is closed change nothing."""
    wire = read_parts(spark, batched_wire(spark, sf_dir))
    return _drained(spark, sf_dir, windows.tumbling_metrics(with_delay(parse_events(wire), WindowConfig.watermark), "1 hour"))


@query
def stream_restart(spark, sf_dir):
    """A stream that stops after half of the time and goes on from its checkpoint."""
    events = timed_part(read_events(spark, sf_dir))
    source, path, checkpoint = (work_dir(spark, name) for name in ("restart-wire", "stream", "checkpoint"))
    for half in ((0, 1), (2, 3)):
        for place in half:
            write_part(encode_events(events.filter(F.col("part") == place)), source)
        wire = read_parts(spark, source)
        metrics = windows.tumbling_metrics(clean_events(wire, StreamConfig()), "1 hour")
        with state_partitions(spark, _state_count(spark, sf_dir)):
            started = sinks.start_append(metrics, path, checkpoint)
        started.awaitTermination()
    return spark.read.schema(metrics.schema).parquet(path)


@query
def compact_table(spark, sf_dir):
    """Hourly revenue appended in four batches; the closed dates, compacted."""
    events = timed_part(read_events(spark, sf_dir, kinds=("purchase",)))
    path, out = work_dir(spark, "revenue"), work_dir(spark, "compacted")
    for place in range(PARTS):
        sinks.append(sinks.with_date(windows.device_breakdown(events.filter(F.col("part") == place), "1 hour")), path, ("event_date",))
    sinks.compact_dates(spark, path, out, until="2024-01-20")
    return spark.read.parquet(out)


@query
def stream_landing(spark, sf_dir):
    """Five micro-batches with late copies, a date in the future and broken rows: every wire row is landed or rejected."""
    base = work_dir(spark, "landing")
    config = StreamConfig(
        base_path=base, checkpoint_dir=f"{base}-checkpoints", shuffle_partitions=_state_count(spark, sf_dir),
        windows=WindowConfig(short="1 hour", long="1 hour", slide="1 hour"),
    )
    wire = read_parts(spark, batched_wire(spark, sf_dir))
    job = start_all(spark, config, wire, once=True)
    counts = [
        job.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"))
        for name in ("raw", "rejects", "misdated")
    ]
    hours = job.read("metrics_1min").agg(F.lit("metric_events").alias("name"), F.sum("total_events").alias("rows"))
    return reduce(DataFrame.unionByName, [*counts, hours])


#: Events of a state partition when a whole table runs through a stream.
STATE_EVENTS = 50_000


def _state_count(spark: SparkSession, sf_dir: str) -> int:
    """State partitions for a whole-table run, which is one large micro-batch: one per core the session offers, and with more
    events so many that the rows a task aggregates, copies for sliding windows among them, stay as many as before."""
    events = raw_events(spark, sf_dir).count()
    return max(spark.sparkContext.defaultParallelism, -(-events // STATE_EVENTS))


@query
def stream_metrics(spark, sf_dir):
    """Hourly metrics as a stream: all windows the watermark closed."""
    return _streamed(spark, sf_dir, lambda events: windows.tumbling_metrics(events, "1 hour"))


@query
def stream_sliding(spark, sf_dir):
    """Five-minute metrics every 30 seconds as a stream."""
    return _streamed(spark, sf_dir, windows.sliding_metrics)


@query
def stream_sliding_long(spark, sf_dir):
    """One-hour metrics every five minutes as a stream: twelve windows hold each event, and none is copied into them."""
    return _streamed(spark, sf_dir, lambda events: windows.sliding_metrics(events, "1 hour", "5 minutes"))


@query
def stream_device(spark, sf_dir):
    """Hourly device rows as a stream."""
    return _streamed(spark, sf_dir, lambda events: windows.device_breakdown(events, "1 hour"))


@query
def stream_revenue(spark, sf_dir):
    """Hourly purchases as a stream."""
    return _streamed(spark, sf_dir, lambda events: windows.revenue(events, "1 hour"))


@query
def stream_page_counts(spark, sf_dir):
    """Hourly page views as a stream."""
    return _streamed(spark, sf_dir, lambda events: windows.page_counts(events, "1 hour"))


@query
def stream_top_pages(spark, sf_dir):
    """The three most viewed pages of every closed hour, ranked when the streamed counts are read."""
    counts = _streamed(spark, sf_dir, lambda events: windows.page_counts(events, "1 hour"))
    return windows.rank_pages(counts, 3)


def _landed(spark: SparkSession, wire: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Lands a wire stream as the job does and reads the table."""
    rows = landing(wire, StreamConfig.clock_skew)
    started = sinks.start_archive(rows, path, checkpoint, partition_cols=("kind", "event_date"))
    started.awaitTermination()
    return spark.read.schema(LANDED_SCHEMA).parquet(path)


@query
def stream_archive(spark, sf_dir):
    """Events landed by kind and date, counted per date and type."""
    wire = encode_events(read_events(spark, sf_dir, streaming=True))
    landed = landed_rows(_landed(spark, wire, work_dir(spark, "landed"), work_dir(spark, "checkpoint")), EVENT)
    return landed.groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("events"), whole_cents(revenue_parts()).alias("cents")
    )


@query
def landing_restart(spark, sf_dir):
    """Landing that stops in the middle of the wire and goes on: the rows of each kind together are the wire."""
    path, checkpoint, source = (work_dir(spark, name) for name in ("landed", "checkpoint", "wire"))
    damaged = damaged_wire(timed_part(read_events(spark, sf_dir)), "part")
    for half in (0, 1):
        for place in (2 * half, 2 * half + 1):
            write_part(damaged.filter(F.col("part") == place).drop("part"), source)
        landed = _landed(spark, read_parts(spark, source), path, checkpoint)
    return landed.groupBy("kind").agg(
        F.count(F.lit(1)).alias("rows"), F.count("event_date").alias("dated"), F.count("value").alias("texts"), F.count("event_id").alias("named")
    )


@query
def late_corrections(spark, sf_dir):
    """Hourly metrics of a stream to which every seventh event came too late, corrected from what was landed."""
    events = read_events(spark, sf_dir)
    late = F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0
    source, landed, metrics, *checkpoints = (work_dir(spark, f"late-{name}") for name in ("wire", "landed", "metrics", "a", "b"))
    for part in (events.filter(~late), events.filter(late)):
        write_part(encode_events(part), source)
        _landed(spark, read_parts(spark, source), landed, checkpoints[0])
        stream = landed_rows(spark.readStream.schema(LANDED_SCHEMA).parquet(landed), EVENT)
        hourly = windows.tumbling_metrics(with_delay(stream, WindowConfig.watermark), "1 hour")
        with state_partitions(spark, _state_count(spark, sf_dir)):
            started = sinks.start_append(sinks.with_date(hourly), metrics, checkpoints[1], partition_cols=("event_date",))
        started.awaitTermination()
    until = events.agg(F.max("event_ts") - F.expr(f"INTERVAL {WindowConfig.watermark}")).first()[0]
    corrections.correct(spark, landed, metrics, lambda found: windows.tumbling_metrics(found, "1 hour"), "1 hour", ["window_start"], until)
    return corrections.read_corrected(spark, metrics).drop("event_date")


@query
def half_compacted(spark, sf_dir):
    """A streamed table whose older half was compacted, to which rows for closed and open dates were streamed afterwards."""
    events = read_events(spark, sf_dir, kinds=("purchase",))
    path, checkpoint, source = (work_dir(spark, name) for name in ("hours", "checkpoint", "source"))
    late = F.pmod(F.xxhash64("window_start"), F.lit(5)) == 0
    hours = stored(sinks.with_date(windows.revenue(events, "1 hour")), "hours")
    middle = hours.agg(F.date_from_unix_date(F.percentile(F.unix_date("event_date"), 0.5).cast("int"))).first()[0]
    for part in (hours.filter(~late), hours.filter(late)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(hours.schema).parquet(source)
        sinks.start_append(stream, path, checkpoint, partition_cols=("event_date",)).awaitTermination()
        if not path_exists(spark, path + CLOSED):
            sinks.compact_closed(spark, path, middle)
    return read_current(spark, path)


@query
def stream_dedupe(spark, sf_dir):
    """A stream with every event three times, one copy a second late."""
    events = read_events(spark, sf_dir, streaming=True)
    copies = events.withColumn("late", F.explode(F.array(F.lit(0), F.lit(0), F.lit(1))))
    moved = copies.withColumn(
        "event_ts", F.timestamp_micros(F.unix_micros("event_ts") + F.col("late").cast("long") * 1_000_000)
    ).drop("late")
    return _drained(spark, sf_dir, deduplicate(moved, spread=4).select("event_id", "user_id", "event_type", "page", "amount"))


@query
def stream_alerts(spark, sf_dir):
    """Hourly metrics and keyed detector state in one stream, a series per device."""

    def build(events: DataFrame) -> DataFrame:
        metrics = windows.traffic(events, BUSY, ("device",))
        return detect_stream(metrics, BUSY, keys=("device",), detected_at=F.col("window_end"))

    return _streamed(spark, sf_dir, build)


@query
def stream_job(spark, sf_dir):
    """The whole job over the table, with hourly windows: rows and a total per table it wrote."""
    config = StreamConfig(
        base_path=work_dir(spark, "job-tables"),
        checkpoint_dir=work_dir(spark, "job-checkpoints"),
        shuffle_partitions=_state_count(spark, sf_dir),
        windows=WindowConfig(short="1 hour", long="1 hour", slide="10 minutes", top_n=3),
    )
    job = start_all(spark, config, damaged_wire(read_events(spark, sf_dir, streaming=True)), once=True)
    totals = {
        "raw": F.count_if(F.col("event_ts").isNotNull()),
        "rejects": F.count("event_id"),
        "events": F.count("user_id"),
        "metrics_1min": F.sum("total_events"),
        "metrics_5min": F.sum("event_count"),
        "revenue": F.sum("order_count"),
        "devices": F.sum("unique_users"),
        "page_counts": F.sum("view_count"),
        "alerts": F.count_if(F.col("severity") == "critical"),
    }
    written = [
        job.read(name)
        .agg(F.count(F.lit(1)).alias("rows"), total.alias("total"))
        .select(F.lit(name).alias("name"), "rows", "total")
        for name, total in totals.items()
    ]
    return reduce(DataFrame.unionByName, written)

"""Streams against tables: same rows for closed windows, late data, restart, keyed state."""

import pytest
from pyspark.sql import functions as F

from tidewatch.config import StreamConfig, WindowConfig
from tidewatch.operators import anomalies, windows
from tidewatch.operators.dedupe import deduplicate, with_delay
from tidewatch.schema import WIRE_SCHEMA
from tidewatch.session import work_dir
from tidewatch.sources.tables import CLOSED, path_exists
from tidewatch.sources.wire import encode_events, read_wire
from tidewatch.streaming import job as jobs
from tidewatch.streaming.sinks import start_append, start_publish


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def write_files(spark, frames):
    """One wire file per frame, in order."""
    path = work_dir(spark, "wire")
    for place, frame in enumerate(frames):
        encode_events(frame).coalesce(1).write.mode("append").parquet(path)
    return path


def run(df, spark, checkpoint=None, path=None):
    path = path or work_dir(spark, "out")
    query = start_append(df, path, checkpoint or work_dir(spark, "checkpoint"))
    query.awaitTermination()
    return query, spark.read.schema(df.schema).parquet(path)


def wire_events(spark, path, per_trigger=None):
    options = {"maxFilesPerTrigger": str(per_trigger)} if per_trigger else {}
    raw = read_wire(spark, "parquet", options, path)
    return jobs.clean_events(raw, StreamConfig(dedupe_spread=4))


@pytest.fixture(scope="module")
def wire(spark, events):
    return write_files(spark, [events])


def closed(spark, events, metrics, length):
    last = events.agg(F.max("event_ts")).first()[0]
    end = F.col("window_start") + F.expr(f"INTERVAL {length}")
    return metrics.filter(end <= F.lit(last) - F.expr("INTERVAL 10 SECONDS"))


@pytest.mark.parametrize(
    "metric, width",
    [
        (windows.tumbling_metrics, "1 hour"),
        (windows.device_breakdown, "1 hour"),
        (windows.revenue, "1 hour"),
        (windows.page_counts, "1 hour"),
    ],
)
def test_stream_equals_table(spark, events, wire, metric, width):
    _, streamed = run(metric(wire_events(spark, wire), width), spark)
    expected = closed(spark, events, metric(events, width), width)
    assert rows_of(streamed) == rows_of(expected)
    assert streamed.count() > 0


def test_sliding_stream_equals_table(spark, events, wire):
    _, streamed = run(windows.sliding_metrics(wire_events(spark, wire), "1 hour", "10 minutes"), spark)
    expected = closed(spark, events, windows.sliding_metrics(events, "1 hour", "10 minutes"), "1 hour")
    assert rows_of(streamed) == rows_of(expected)


def test_top_pages_stream(spark, events, wire):
    """Counts are appended once for each window, so ranking them on reading is exact."""
    _, counts = run(windows.page_counts(wire_events(spark, wire), "6 hours"), spark)
    expected = closed(spark, events, windows.top_pages(events, 3, "6 hours"), "6 hours")
    assert rows_of(windows.rank_pages(counts, 3)) == rows_of(expected)


def test_late_rows(spark, make_events):
    """A row is dropped once its window ended at or before the previous batch's watermark."""
    def view(second, user):
        return (float(second), user, "page_view", "/p", "mobile", "s", None)

    frames = [
        make_events([view(5, "a"), view(130, "b")]),
        # Watermark 120 s from here on; the batch itself still runs against the one before.
        make_events([view(20, "c"), view(140, "d")]),
        make_events([view(30, "late"), view(150, "e"), view(400, "f")]),
        make_events([view(401, "g")]),
    ]
    numbered = [
        frame.withColumn("event_id", F.concat(F.lit(f"{place}-"), "event_id"))
        for place, frame in enumerate(frames)
    ]
    path = write_files(spark, numbered)
    raw = read_wire(spark, "parquet", {"maxFilesPerTrigger": "1"}, path)
    stream = with_delay(jobs.parse_events(raw), "10 seconds")
    query, out = run(windows.tumbling_metrics(stream, "1 minute"), spark)
    found = {r.window_start.minute: (r.total_events, r.unique_users) for r in out.collect()}
    assert found == {0: (2, 2), 2: (3, 3)}
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped > 0


def test_stream_dedupe(spark, events):
    shifted = events.withColumn("event_ts", F.col("event_ts") + F.expr("INTERVAL 1 SECOND")).withColumn(
        "timestamp", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )
    hot = events.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("copy")
    path = write_files(spark, [events.unionByName(shifted).unionByName(events).unionByName(hot)])
    for spread in (1, 8):
        raw = read_wire(spark, "parquet", {}, path)
        stream = deduplicate(jobs.parse_events(raw), delay="10 seconds", spread=spread)
        _, out = run(stream.select("event_id"), spark)
        assert out.count() == events.count() == out.distinct().count()


def test_restart_equals_one_run(spark, events):
    cut = events.agg(F.expr("percentile(unix_micros(event_ts), 0.5)")).first()[0]
    early = events.filter(F.unix_micros("event_ts") <= cut)
    late = events.filter(F.unix_micros("event_ts") > cut)
    path, out, checkpoint = work_dir(spark, "wire"), work_dir(spark, "out"), work_dir(spark, "checkpoint")
    for part in (early, late):
        encode_events(part).coalesce(1).write.mode("append").parquet(path)
        stream = windows.tumbling_metrics(wire_events(spark, path), "1 hour")
        _, result = run(stream, spark, checkpoint, out)
    whole = closed(spark, events, windows.tumbling_metrics(events, "1 hour"), "1 hour")
    assert rows_of(result) == rows_of(whole)


def alert_rows(df):
    return rows_of(df.select("alert_id", "alert_type", "severity", "current_val", "baseline",
                             "z_score", "pct_change", "message", "window_start", "window_end"))


def test_job_runs_end_to_end(spark, events, wire):
    config = StreamConfig(app_name="once", shuffle_partitions=4, summary_every=1)
    job = jobs.start_all(spark, config, raw=read_wire(spark, "parquet", {}, wire), once=True)
    assert all(query.exception() is None for query in job.queries)
    filled = jobs.TABLES
    for table in filled:
        assert job.read(table).count() > 0, table
    assert job.top_pages().count() > 0
    assert job.read("raw").count() == events.count() and job.read("rejects").count() == 0
    metrics = job.read("metrics_5min")
    expected = anomalies.detect(metrics, "30 seconds", "5 minutes")
    stored = job.read("alerts")
    assert alert_rows(stored) == alert_rows(expected)
    assert {"indexed_at", "event_date"} <= set(stored.columns)
    # Read from the state, the summary is that of the whole history.
    assert job.detector_summary().collect() == anomalies.summary(metrics, "30 seconds", alerts=stored).collect()
    scans = job.detector_summary()._jdf.queryExecution().executedPlan().toString()
    assert "metrics_5min" not in scans and job.detector_summary().first().total_alerts == stored.count()
    assert job.progress().filter("input_rows > 0").count() >= len(filled)
    # A second run finds nothing new and changes nothing.
    before = {table: job.read(table).count() for table in filled}
    again = jobs.start_all(spark, config, raw=read_wire(spark, "parquet", {}, wire), once=True)
    assert {table: again.read(table).count() for table in filled} == before
    # It has compacted the closed dates first, so some rows now come from their copies.
    assert path_exists(spark, again.path("events") + CLOSED)
    totals = {r.query: r for r in job.total_progress().collect()}
    assert totals["landed"].input_rows == events.count() and all(t.late_rows == 0 for t in totals.values())


def test_one_date_in_the_future_loses_nothing(spark, make_events):
    """Batches of good events, one event dated years ahead and broken rows: all are landed, none of the good is late."""
    frames = []
    for batch in range(6):
        rows = [(120.0 * batch + i, f"u{i}", "page_view", "/p", "mobile", "s", None) for i in range(20)]
        frame = make_events(rows).withColumn("event_id", F.concat(F.lit(f"{batch}-"), "event_id"))
        if batch == 1:
            ahead = frame.limit(1).withColumns({"event_id": F.lit("ahead"), "timestamp": F.lit("2090-01-01T00:00:00+00:00")})
            frame = frame.unionByName(ahead)
        if batch == 2:
            frame = frame.unionByName(frame.limit(3).withColumn("user_id", F.lit(None).cast("string")))
        frames.append(frame)
    path = write_files(spark, frames)
    config = StreamConfig(app_name="future", shuffle_partitions=2, windows=WindowConfig(long="2 minutes", slide="1 minute"))
    raw = read_wire(spark, "parquet", {"maxFilesPerTrigger": "1"}, path)
    job = jobs.start_all(spark, config, raw=raw, once=True)
    count = {table: job.read(table).count() for table in ("raw", "rejects", "misdated", "events")}
    assert count == {"raw": 121, "rejects": 3, "misdated": 1, "events": 120}
    rejected = job.read("rejects").first()
    assert rejected.event_id and '"page":"/p"' in rejected.value
    assert all(t.late_rows == 0 for t in job.total_progress().collect())


def test_job_live_mode_stops_cleanly(spark, wire):
    config = StreamConfig(app_name="live", shuffle_partitions=2, micro_batch_seconds=1)
    job = jobs.start_all(spark, config, raw=read_wire(spark, "parquet", {}, wire))
    try:
        assert len(job.queries) == len(jobs.TABLES)
        job.queries[0].processAllAvailable()
        assert job.read("raw").count() > 0
    finally:
        job.stop()
    assert not any(query.isActive for query in job.queries)
    assert all(query.exception() is None for query in job.queries)


def test_stream_alerts_survive_restart(spark):
    """State of the detector comes back from the checkpoint; gaps are filled across batches."""
    from tidewatch.streaming.baseline import detect_stream

    schema = "window_start timestamp, event_count long, revenue double, active_users long"
    counts = [100, 102, 98, 101, 99, 100, 103, 97, 100, 101, 99, 1000, 100, None, None, 5, 100, 40, 100]
    rows = [
        (minute, count, 900.0 if minute % 3 else 100.0, 40)
        for minute, count in enumerate(counts) if count is not None
    ]
    metrics = spark.createDataFrame(rows, "minute int, event_count long, revenue double, active_users long").select(
        F.timestamp_micros(F.lit(1704067200000000) + F.col("minute").cast("long") * 60000000).alias("window_start"),
        "event_count", "revenue", "active_users",
    )
    expected = anomalies.detect(metrics, "1 minute")
    path, out, checkpoint = work_dir(spark, "metrics"), work_dir(spark, "out"), work_dir(spark, "checkpoint")
    split = F.timestamp_micros(F.lit(1704067200000000 + 14 * 60000000))
    for part in (metrics.filter(F.col("window_start") < split), metrics.filter(F.col("window_start") >= split)):
        part.coalesce(1).write.mode("append").parquet(path)
        _, result = run(detect_stream(spark.readStream.schema(schema).parquet(path), "1 minute"), spark, checkpoint, out)
    assert alert_rows(result) == alert_rows(expected)
    kinds = {row.alert_type for row in result.collect()}
    assert kinds == {"spike", "drop", "revenue_drop", "zero_events"}


@pytest.mark.parametrize("metric, levels", [(windows.tumbling_metrics, 2), (windows.sliding_metrics, 3), (windows.device_breakdown, 2)])
def test_streams_combine_before_every_shuffle(spark, wire, metric, levels):
    query, _ = run(metric(wire_events(spark, wire)), spark)
    lines = query._jsq.explainInternal(False).splitlines()
    shuffles = [place for place, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == levels + 2
    for place in shuffles[:levels]:
        assert "partial_" in lines[place + 1]
    # Below them the two passes of the dedupe, the first over id and bucket.
    assert "_bucket" in lines[shuffles[levels + 1]] and "_bucket" not in lines[shuffles[levels]]


def test_publish_stream(spark, events):
    source, out = work_dir(spark, "events"), work_dir(spark, "wire")
    events.write.parquet(source)
    stream = encode_events(spark.readStream.schema(events.schema).parquet(source))
    start_publish(stream, "parquet", {"path": out}, work_dir(spark, "checkpoint")).awaitTermination()
    back = jobs.parse_events(read_wire(spark, "parquet", path=out, streaming=False))
    assert rows_of(back.select("event_id", "amount")) == rows_of(events.select("event_id", "amount"))


def test_wire_schema_names():
    assert WIRE_SCHEMA.fieldNames() == ["key", "value"]


def test_processor_travels_with_its_code(tmp_path):
    """Executors need no copy of the package to load the keyed-state processor."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from tidewatch.streaming.baseline import RollingBaseline

    stored_at = tmp_path / "processor"
    stored_at.write_bytes(cloudpickle.dumps(RollingBaseline(20, 60)))
    check = f"import pickle; print(pickle.load(open({str(stored_at)!r}, 'rb')).stride)"
    done = subprocess.run([sys.executable, "-c", check], cwd="/", capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "60", done.stderr


def test_outage_raises_alerts_without_any_event(spark):
    """No row arrives after the first batch, yet empty windows are emitted while the clock goes on."""
    import time

    from tidewatch.streaming.baseline import detect_stream

    schema = "window_start timestamp, event_count long, revenue double, active_users long"
    path, out = work_dir(spark, "metrics"), work_dir(spark, "out")
    now = int(time.time())
    rows = spark.range(0, 12).select(
        F.timestamp_seconds(F.lit(now - 14) + F.col("id")).alias("window_start"),
        F.lit(100).cast("long").alias("event_count"), F.lit(5.0).alias("revenue"), F.lit(3).cast("long").alias("active_users"),
    )
    rows.coalesce(1).write.parquet(path)
    stream = detect_stream(spark.readStream.schema(schema).parquet(path), "1 second", patience="1 second")
    query = start_append(stream, out, work_dir(spark, "checkpoint"), seconds=1)
    found = None
    try:
        for _ in range(60):
            time.sleep(1)
            assert query.exception() is None
            found = spark.read.schema(stream.schema).parquet(out).filter("alert_type = 'zero_events'")
            if found.count() >= 3:
                break
    finally:
        query.stop()
    starts = sorted(r.window_start.timestamp() for r in found.collect())
    assert len(starts) >= 3 and starts == list(range(int(starts[0]), int(starts[0]) + len(starts))) and starts[0] == now - 2


@pytest.mark.parametrize("width, slide", [("5 minutes", "30 seconds"), ("1 hour", "10 minutes")])
def test_sliding_stream_copies_panes_and_not_events(spark, wire, width, slide):
    """Below every copy into windows stands an aggregate, and no aggregate copies events."""
    query, _ = run(windows.sliding_metrics(wire_events(spark, wire), width, slide), spark)
    lines = query._jsq.explainInternal(False).splitlines()
    copies = [place for place, line in enumerate(lines) if "Expand" in line]
    exchanges = [place for place, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    # Below the copies: the shuffle of the panes, then those of the dedupe.
    assert copies and all(any(copy < place and "event_id" not in lines[place] for place in exchanges) for copy in copies)


# ---------------------------------------------------------------- the detector's two clocks

SECOND = 1_000_000
STEP, WIDTH, DELAY, PATIENCE = 30 * SECOND, 300 * SECOND, 10 * SECOND, 60 * SECOND


class Live:
    """The detector's processor with a state and a clock of its own."""

    def __init__(self, **more):
        from types import SimpleNamespace

        from tidewatch.streaming.baseline import RollingBaseline

        self.timers, self.value, self.make = [], None, SimpleNamespace
        self.processor = RollingBaseline(20, STEP, WIDTH, DELAY, PATIENCE, **more)
        state = SimpleNamespace(exists=lambda: self.value is not None, get=lambda: self.value, update=self._put)
        self.processor.init(
            SimpleNamespace(
                getValueState=lambda *_: state, listTimers=lambda: list(self.timers), deleteTimer=self.timers.remove,
                registerTimer=self.timers.append,
            )
        )

    def _put(self, value):
        self.value = value

    def batch(self, now, *rows):
        """One micro-batch: rows ``(start, count)`` first, then the timers that are due."""
        clock = self.make(getCurrentProcessingTimeInMs=lambda: now // 1000)
        given = [self.make(start=s, event_count=c, revenue_cents=10 * c, active_users=c) for s, c in rows]
        out = list(self.processor.handleInputRows(("k",), iter(given), clock)) if given else []
        for timer in [t for t in self.timers if t <= now // 1000]:
            self.timers.remove(timer)
            out += self.processor.handleExpiredTimer(("k",), clock, None)
        return out


START = 1_700_000_010 * SECOND
LATENCY = 7 * SECOND


def steady(live, n):
    out = []
    for i in range(n):
        seen = START + i * STEP + WIDTH + DELAY + LATENCY
        out += live.batch(seen, (START + i * STEP, 100)) + live.batch(seen + STEP // 2)
    return out


def test_steady_traffic_with_overlapping_windows_raises_nothing():
    rows = steady(Live(), 200)
    assert [r.window_no for r in rows] == list(range(1, 201))
    assert all(r.event_count == 100 and not r.replaces for r in rows) and rows[-1].count_sum == 2000


def test_an_outage_reports_each_window_once_and_late_rows_replace_theirs():
    live = Live()
    last = START + 99 * STEP
    steady(live, 100)
    reported = []
    for k in range(400):
        reported += live.batch(last + WIDTH + DELAY + LATENCY + k * SECOND)
    until = (LATENCY + 399 * SECOND - PATIENCE) // STEP
    assert [(r.start - last) // STEP for r in reported] == list(range(1, until + 1)) and until == 11
    assert [r.window_no for r in reported] == list(range(101, 112)) and not any(r.replaces or r.event_count for r in reported)
    assert [r.count_sum for r in reported[:3]] == [2000, 1900, 1800]
    now = last + WIDTH + DELAY + 500 * SECOND
    # The row of the third one comes after all: it replaces what was reported, the two before it settle without another row.
    third = live.batch(now, (last + 3 * STEP, 90))
    assert [(r.start - last, r.event_count, r.replaces, r.window_no, r.count_sum) for r in third[:1]] == [(3 * STEP, 90, True, 103, 1800)]
    # Those behind it had a zero too many in their baseline: they are corrected as they settle.
    rest = live.batch(now + SECOND, (last + 20 * STEP, 100))
    settled = {(r.start - last) // STEP: r for r in rest}
    assert sorted(settled) == list(range(4, 21)) and settled[20].event_count == 100 and settled[4].count_sum == 90 + 17 * 100
    again = {k for k, r in settled.items() if r.replaces}
    assert again == {(r.start - last) // STEP for r in reported + third} - {1, 2, 3}
    assert settled[20].window_no == 120 and live.value[5] is None


def test_traffic_after_an_outage_gives_each_window_once():
    live = Live()
    steady(live, 30)
    last = START + 29 * STEP
    reported = [r for k in range(40) for r in live.batch(last + WIDTH + DELAY + PATIENCE + k * 10 * SECOND)]
    rows = live.batch(last + WIDTH + DELAY + 500 * SECOND, *((last + k * STEP, 100) for k in range(14, 30)))
    starts = [r.start for r in reported + rows]
    assert len(starts) == len(set(starts)) and sorted(starts) == list(range(last + STEP, last + 30 * STEP, STEP))
    assert not any(r.replaces for r in rows) and [r.window_no for r in reported + rows][-1] == 59


def test_a_long_hole_ends_a_segment_on_a_stream():
    live = Live(gap=20 * STEP)
    rows = live.batch(START, (START, 100)) + live.batch(START, (START + 10**9 * SECOND, 50))
    assert len(rows) == 22 and [r.event_count for r in rows] == [100] + [0] * 20 + [50]
    assert (rows[-1].window_no, rows[-1].count_n) == (1, 0) and live.value[0] == 1 and live.value[7] == 21
    # A series that stays silent is reported up to there, and no further.
    live = Live(gap=20 * STEP)
    steady(live, 5)
    silent = [r for k in range(200) for r in live.batch(START + 4 * STEP + WIDTH + DELAY + PATIENCE + k * STEP)]
    assert len(silent) == 20 and not live.timers


def test_alerts_of_replaced_windows_are_withdrawn(spark):
    """A window reported as empty, then replaced by a usual one: its alerts are taken back in the index, its totals and its readers."""
    from pyspark.sql import Row

    from tidewatch.operators import serving
    from tidewatch.operators.anomalies import build_alerts
    from tidewatch.streaming.baseline import OUTPUT
    from tidewatch.streaming.sinks import index_alerts

    live = Live()
    steady(live, 30)
    last, path = START + 29 * STEP, work_dir(spark, "alerts")
    names = [part.split()[0] for part in OUTPUT.replace("(38,0)", "").split(", ")]

    def index(rows, name):
        frame = spark.createDataFrame([Row(*names)(*r) for r in rows], OUTPUT).withColumn("window_start", F.timestamp_micros("start"))
        index_alerts(build_alerts(frame.drop("start"), "5 minutes"), path, work_dir(spark, name), F.col("window_end"))

    index([r for k in range(13) for r in live.batch(last + WIDTH + DELAY + PATIENCE + k * 10 * SECOND)], "first")
    table = spark.read.parquet(path)
    kinds = sorted((r.alert_type, r.window_start) for r in table.filter("NOT withdrawn").collect())
    assert [k for k, _ in kinds] == ["drop"] * 4 + ["zero_events"] * 4
    index(live.batch(last + WIDTH + DELAY + 200 * SECOND, (last + 2 * STEP, 100)), "second")
    left = spark.read.parquet(path).filter("NOT withdrawn")
    assert {r.window_start for r in left.collect()} == {kinds[k][1] for k in (0, 2, 3)}
    totals = spark.read.parquet(path + "-totals").groupBy().sum("alerts").first()[0]
    assert totals == left.count() == 6 == serving.search_alerts(spark.read.parquet(path)).count() == serving.search_index(spark, path).count()


def test_corrections_compute_only_the_dates_that_changed(spark, make_events):
    """Late events of two dates are merged into their windows; a third date and windows that may be open are left alone."""
    from datetime import datetime

    from tidewatch.operators.parse import landing
    from tidewatch.streaming import corrections

    source, landed, metrics, *checkpoints = (work_dir(spark, name) for name in ("wire", "landed", "metrics", "a", "b"))
    day = 86_400.0

    def arrive(rows, tag):
        events = make_events(rows).withColumn("event_id", F.concat(F.lit(tag), "event_id"))
        encode_events(events).coalesce(1).write.mode("append").parquet(source)
        start_append(landing(read_wire(spark, "parquet", {}, source), "1 hour"), landed, checkpoints[0], partition_cols=("kind", "event_date")).awaitTermination()
        stream = with_delay(jobs.landed_rows(spark.readStream.schema(jobs.LANDED_SCHEMA).parquet(landed), jobs.EVENT), "10 seconds")
        table = jobs.with_date(windows.sliding_metrics(stream, "2 hours", "1 hour"))
        start_append(table, metrics, checkpoints[1], partition_cols=("event_date",)).awaitTermination()

    def fix(until):
        compute = lambda events: windows.sliding_metrics(events, "2 hours", "1 hour")
        return [str(d) for d in corrections.correct(spark, landed, metrics, compute, "2 hours", ["window_start"], until)]

    def found():
        return rows_of(corrections.read_corrected(spark, metrics).select("window_start", "event_count", "active_users"))

    def whole(until):
        raw = jobs.landed_rows(spark.read.parquet(landed), jobs.EVENT)
        rows = windows.sliding_metrics(deduplicate(raw), "2 hours", "1 hour").filter(F.col("window_end") <= F.lit(until))
        return rows_of(rows.select("window_start", "event_count", "active_users"))

    def view(second, user):
        return (second, user, "page_view", "/p", "mobile", "s", None)

    arrive([view(k * 7200.0, f"u{k}") for k in range(60)], "a")
    until = datetime(2024, 1, 5)
    assert fix(until)[0] == "2023-12-31"
    assert set(found()) >= set(whole(until))
    # Late ones on the first and the fourth date, one of them twice, the first window reaching into the day before.
    arrive([view(10.0, "late"), view(10.0, "late"), view(3 * day + 5, "late"), view(4.9 * day, "on time")], "b")
    dropped = found()
    assert fix(until) == ["2023-12-31", "2024-01-01", "2024-01-03", "2024-01-04"]
    assert found() != dropped and set(found()) >= set(whole(until))
    assert fix(until) == []
    # The next midnight takes the date that was open.
    assert fix(datetime(2024, 1, 6)) == ["2024-01-04", "2024-01-05"]
    closed = spark.read.parquet(metrics).agg(F.max("window_end")).first()[0]
    assert {r for r in found() if r[0] < closed} >= {r for r in whole(datetime(2024, 1, 5, 21)) if r[0] < closed}
    again = corrections.events_of(spark.read.parquet(landed), [until.date()])
    scan = again._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in scan and "2024-01-05" in scan


def test_job_in_another_format(spark, wire):
    """Every table of the job, read and written in the format it is told."""
    config = StreamConfig(app_name="orc", shuffle_partitions=2, table_format="orc", windows=WindowConfig(long="1 hour", slide="30 minutes"))
    job = jobs.start_all(spark, config, raw=read_wire(spark, "parquet", {}, wire), once=True)
    for table in jobs.TABLES:
        assert spark.read.orc(job.path(table)).count() == job.read(table).count() > 0, table
    assert job.detector_summary().count() == 1 and job.top_pages().count() > 0
    jobs.start_all(spark, config, raw=read_wire(spark, "parquet", {}, wire), once=True)
    assert job.read("raw").count() == spark.read.orc(job.path("landed")).count()


def test_state_partitions_follow_the_events(spark, tmp_path):
    """With more events there are more state partitions, so that the rows of a task stay as many."""
    from tidewatch.plans import queries

    for events in (1000, 20 * queries.STATE_EVENTS + 1):
        rows = spark.range(events).selectExpr(
            "id AS event_id", "timestamp_ntz'2024-01-01' AS ts", "id AS user_id", "'view' AS event_type", "1D AS value", "'' AS props"
        )
        rows.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        assert queries._state_count(spark, str(tmp_path)) == (spark.sparkContext.defaultParallelism if events == 1000 else 21)


def test_state_stores_reserve_no_disk(spark, events, wire):
    """A store takes the disk that its rows need, not some megabytes ahead of them."""
    import os

    local = spark._jvm.org.apache.spark.util.Utils.getLocalDir(spark._jsc.sc().conf())
    manifests = lambda: {f"{at}/{name}" for at, _, names in os.walk(local) for name in names if name.startswith("MANIFEST")}
    before = manifests()
    run(windows.revenue(wire_events(spark, wire), "1 hour"), spark)
    mine = manifests() - before
    assert mine and max(os.stat(name).st_blocks * 512 for name in mine) < 1 << 20
    assert spark.conf.get("spark.sql.streaming.stateStore.compression.codec") == "zstd"


def busy(make_events, minutes=6, users=300):
    """Each user every 20 seconds, some of them with gaps and some without an amount."""
    return make_events([
        (second + user / users, f"u{user}", "purchase" if user % 3 else "click", "/p1", "mobile", "s1", float(user) if user % 5 else None)
        for second in range(0, 60 * minutes, 20) for user in range(users) if user % 7 or second % 60 == 0
    ])


def test_sliding_stream_keeps_users_as_sets(spark, make_events):
    """The state of sliding windows has a row for each bucket of users, not one for each user and window."""
    found = busy(make_events)
    query, streamed = run(windows.sliding_metrics(wire_events(spark, write_files(spark, [found])), "5 minutes", "30 seconds"), spark)
    expected = closed(spark, found, windows.sliding_metrics(found, "5 minutes", "30 seconds"), "5 minutes")
    assert rows_of(streamed) == rows_of(expected) and streamed.count() > 0
    # The last three operators of a batch are those of windows, of windows and users, and of panes; the others are of the dedupe.
    most = max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators[:3])
    panes = 12
    assert most <= (panes + 10) * windows.USER_BUCKETS


def test_sliding_stream_counts_users_of_several_batches_once(spark, make_events):
    found = busy(make_events, minutes=8, users=40)
    parts = [found.filter(F.minute("event_ts").between(*span)) for span in ((0, 2), (3, 4), (5, 7))]
    _, streamed = run(windows.sliding_metrics(wire_events(spark, write_files(spark, parts), 1), "2 minutes", "30 seconds"), spark)
    expected = closed(spark, found, windows.sliding_metrics(found, "2 minutes", "30 seconds"), "2 minutes")
    assert rows_of(streamed) == rows_of(expected) and streamed.count() > 0

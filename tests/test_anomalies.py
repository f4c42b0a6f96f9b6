"""Rolling baselines and rules: fixed cases and a brute-force comparison."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidewatch.config import DetectorConfig
from tidewatch.functions.baseline import Baseline
from tidewatch.operators import anomalies, series

MINUTE = 60_000_000
ORIGIN = 1_704_067_200_000_000


@pytest.fixture
def make_metrics(spark):
    """One row per (count, revenue, users); ``None`` leaves a hole."""

    def build(values, name="all"):
        rows = [(name, ORIGIN + i * MINUTE, *v) for i, v in enumerate(values) if v is not None]
        frame = spark.createDataFrame(
            rows, "series_key string, start long, event_count long, revenue double, active_users long"
        )
        return frame.select("series_key", F.timestamp_micros("start").alias("window_start"),
                            "event_count", "revenue", "active_users")

    return build


# Fifteen ordinary windows, in fixed values.
NORMAL = [(90 + (i * 7) % 21, 800.0 + (i * 37) % 401, 40 + (i * 5) % 21) for i in range(15)]


def kinds(df):
    return [(r.alert_type, r.severity) for r in df.orderBy("window_start", "alert_type").collect()]


def figures(spark, samples, value, size=20):
    """Baseline figures of one list of samples, through the SQL expressions."""
    kept = samples[-size:]
    base = Baseline("x")
    row = spark.range(1).selectExpr(
        f"{len(kept)}L AS x_n", f"{sum(kept)}L AS x_sum",
        f"cast({sum(v * v for v in kept)} AS decimal(38,0)) AS x_squares",
    ).selectExpr(base.mean, base.std, base.samples, base.z_score(f"{value}L"), base.change(f"{value}L")).first()
    return tuple(row)


@pytest.mark.parametrize(
    "samples, value, size, expected",
    [
        ([], 50, 20, (0.0, 0.0, 0, 0.0, 0.0)),
        ([100], 100, 20, (100.0, 0.0, 1, 0.0, 0.0)),
        ([10, 20, 30, 40, 50], 30, 20, (30.0, math.sqrt(200), 5, 0.0, 0.0)),
        ([2, 4, 4, 4, 5, 5, 7, 9], 9, 20, (5.0, 2.0, 8, 2.0, 0.8)),
        (list(range(10)), 7, 5, (7.0, math.sqrt(2), 5, 0.0, 0.0)),
        ([100] * 20, 500, 20, (100.0, 0.0, 20, 0.0, 4.0)),
        ([100] * 20, 10, 20, (100.0, 0.0, 20, 0.0, -0.9)),
        ([100] * 5, 150, 20, (100.0, 0.0, 5, 0.0, 0.5)),
        ([100] * 5, 60, 20, (100.0, 0.0, 5, 0.0, -0.4)),
    ],
)
def test_rolling_figures(spark, samples, value, size, expected):
    assert figures(spark, samples, value, size) == pytest.approx(expected)


@pytest.mark.parametrize(
    "last, expected",
    [
        ((1000, 5000.0, 400), [("spike", "high")]),
        ((5, 10.0, 2), [("drop", "critical"), ("revenue_drop", "critical")]),
        ((100, 50.0, 40), [("revenue_drop", "critical")]),
        ((55, 1000.0, 40), [("drop", "medium")]),
        ((45, 1000.0, 40), [("drop", "high")]),
        ((100, 600.0, 40), [("revenue_drop", "high")]),
        ((100, 0.0, 40), []),
        ((0, 0.0, 0), [("drop", "critical"), ("zero_events", "critical")]),
    ],
)
def test_rules(make_metrics, last, expected):
    assert kinds(anomalies.detect(make_metrics([*NORMAL, last]), "1 minute")) == expected


def test_quiet_cases(make_metrics):
    calm = [(92 + i, 850.0 + 30 * i, 42 + i) for i in range(10)]
    assert kinds(anomalies.detect(make_metrics([*NORMAL, *calm]), "1 minute")) == []
    assert kinds(anomalies.detect(make_metrics([(10000, 0.0, 1)]), "1 minute")) == []


def test_zero_events_needs_three_windows_before(make_metrics):
    early = [(100, 900.0, 40), (0, 0.0, 0), (100, 900.0, 40), (0, 0.0, 0), (0, 0.0, 0)]
    found = anomalies.detect(make_metrics(early), "1 minute").orderBy("window_start").collect()
    assert [r.window_start.minute for r in found] == [3, 4]
    assert {(r.alert_type, r.severity, r.z_score, r.pct_change) for r in found} == {
        ("zero_events", "critical", -99.0, -100.0)
    }
    assert found[0].baseline == pytest.approx(200 / 3)


def test_holes_are_windows_without_events(make_metrics):
    metrics = make_metrics([*NORMAL, None, None, (100, 900.0, 40)])
    found = anomalies.detect(metrics, "1 minute")
    assert kinds(found) == [("drop", "critical"), ("zero_events", "critical")] * 2
    filled = series.fill_gaps(series.with_series(metrics), "1 minute", block=4)
    assert [r.window_no for r in filled.orderBy("window_no").collect()] == list(range(1, 19))


def test_gaps_can_reach_past_the_last_row(make_metrics):
    until = F.timestamp_micros(F.lit(ORIGIN + 6 * MINUTE))
    filled = series.fill_gaps(series.with_series(make_metrics(NORMAL[:4])), "1 minute", until=until)
    assert [r.event_count for r in filled.orderBy("window_no").collect()][4:] == [0, 0, 0]
    silent = anomalies.detect(make_metrics(NORMAL[:4]), "1 minute", until=until)
    assert kinds(silent) == [("zero_events", "critical")] * 3


def test_alert_texts(make_metrics):
    spike = anomalies.detect(make_metrics([(100, 1000.0, 40), (102, 1000.0, 40)] * 6 + [(505, 250.0, 40)]), "1 minute")
    rows = {r.alert_type: r for r in spike.collect()}
    assert rows["spike"].message == "Traffic spike: 505 events (400% above baseline 101)"
    assert rows["spike"].alert_id == f"spike_all_{ORIGIN + 12 * MINUTE}"
    assert (rows["spike"].baseline, rows["spike"].pct_change, rows["spike"].z_score) == (101.0, 400.0, 404.0)
    assert rows["revenue_drop"].message == "Revenue drop: $250.00 (75% below baseline $1000.00)"
    assert rows["revenue_drop"].current_val == 250.0 and rows["revenue_drop"].metric == "revenue"
    assert (rows["spike"].window_end - rows["spike"].window_start).seconds == 60
    assert rows["spike"].timestamp is not None


def test_thresholds_are_parameters(make_metrics):
    metrics = make_metrics([*NORMAL, (80, 1000.0, 40)])
    assert kinds(anomalies.detect(metrics, "1 minute")) == []
    strict = DetectorConfig(drop=0.1)
    assert ("drop", "medium") in kinds(anomalies.detect(metrics, "1 minute", config=strict))


def brute_force(values, size):
    """Baselines per window, by walking through the list."""
    samples, out = {"count": [], "revenue": [], "users": []}, []
    for count, revenue, users in values:
        now = {"count": count, "revenue": round(revenue * 100), "users": users}
        out.append({name: tuple(kept[-size:]) for name, kept in samples.items()})
        for name, value in now.items():
            if name == "count" or value > 0:
                samples[name].append(value)
    return out


@pytest.mark.parametrize("size, block", [(3, 4), (5, 5), (4, 64)])
def test_blocks_do_not_change_baselines(spark, make_metrics, size, block):
    """Cutting a series into blocks gives what a walk over the whole series gives."""
    rng = random.Random(size)
    metrics, expected = None, {}
    for name, length in (("a", 60), ("b", 7), ("c", 1)):
        values = [
            (rng.randint(0, 9), rng.choice([0.0, 0.0, round(rng.uniform(1, 99), 2)]), rng.choice([0, 0, 0, rng.randint(1, 5)]))
            for _ in range(length)
        ]
        frame = make_metrics(values, name)
        metrics = frame if metrics is None else metrics.unionByName(frame)
        for place, stats in enumerate(brute_force(values, size), 1):
            expected[name, place] = stats
    filled = series.fill_gaps(series.with_series(metrics, "series_key"), "1 minute", block=block)
    rows = series.with_baselines(filled, size, block=block).collect()
    assert len(rows) == len(expected)
    for row in rows:
        for name, samples in expected[row.series, row.window_no].items():
            got = (row[f"{name}_n"], row[f"{name}_sum"] or 0, int(row[f"{name}_squares"] or 0))
            assert got == (len(samples), sum(samples), sum(s * s for s in samples)), (row.series, row.window_no, name)


def test_series_are_independent(make_metrics):
    both = make_metrics([*NORMAL, (1000, 5000.0, 400)], "a").unionByName(make_metrics(NORMAL, "b"))
    found = anomalies.detect(both, "1 minute", keys=("series_key",))
    assert [(r.series, r.alert_type) for r in found.collect()] == [("a", "spike")]


def test_summary(make_metrics):
    row = anomalies.summary(make_metrics([*NORMAL, (1000, 0.0, 400)]), "1 minute").first()
    counts = [c for c, _, _ in NORMAL] + [1000]
    revenue = [r for _, r, _ in NORMAL]
    assert row.batches_processed == 16 and row.total_alerts == 1
    assert row.count_samples == 16 and row.revenue_samples == 15
    assert row.count_mean == pytest.approx(float(round(Fraction(sum(counts), 16), 1)), abs=0.051)
    assert row.revenue_mean == pytest.approx(sum(revenue) / 15, abs=0.0051)


def test_no_window_spans_a_whole_series(make_metrics):
    """Row-level window functions are cut by block as well as by series."""
    plan = anomalies.detect(make_metrics(NORMAL), "1 minute")._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "RangeFrame" in line:
            assert "block#" in line


def test_series_names_never_collide(spark):
    keys = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("(none)", "c"), ("\\0", "c"), ("a\\", "p"), ("a\\p", ""), ("a|", ""), ("", "a")]
    names = [r.series for r in series.with_series(spark.createDataFrame(keys, "x string, y string"), "x", "y").collect()]
    assert len(set(names)) == len(keys)


def test_baseline_longer_than_a_block(spark):
    rows = [(i * 60, 10 + i % 7, 1.0, 1) for i in range(40)]
    metrics = spark.createDataFrame(rows, "s long, event_count long, revenue double, active_users long").selectExpr(
        "timestamp_seconds(s) AS window_start", "event_count", "revenue", "active_users"
    )
    filled = series.fill_gaps(series.with_series(metrics), "1 minute")
    found = series.with_baselines(filled, 25, block=4).orderBy("window_no").collect()
    assert [r.count_n for r in found] == [min(i, 25) for i in range(40)]


def moments(spark, seconds, count=5):
    rows = [(s, count) for s in seconds]
    return spark.createDataFrame(rows, "s long, event_count long").select(
        F.timestamp_seconds("s").alias("window_start"), "event_count", F.lit(1.0).alias("revenue"), F.lit(1).cast("long").alias("active_users")
    )


def test_windows_53_years_apart_are_two_short_segments(spark):
    """A date in 1971 adds a segment of its own, and not 56 million windows."""
    early, late = 31_536_000, 1_704_067_200
    metrics = moments(spark, [early, *(late + 30 * k for k in range(15))])
    filled = series.fill_gaps(series.with_series(metrics), "30 seconds", gap="1 hour")
    found = {r.segment: (r.n, r.most, r.full) for r in filled.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.max("window_no").alias("most"), F.count_if(F.col("event_count") > 0).alias("full")).collect()}
    assert found == {1: (121, 121, 1), 2: (15, 15, 15)}
    alerts = anomalies.detect(metrics, "30 seconds", config=anomalies.DetectorConfig(longest_gap="1 hour"))
    kinds = alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("n"), F.max("window_start").alias("last")).collect()
    assert {(r.alert_type, r.n) for r in kinds} == {("zero_events", 118), ("drop", 11)}
    assert max(r.last.timestamp() for r in kinds) == early + 3600


@pytest.mark.parametrize("gap, segments", [("2 minutes", [(0, 12), (300, 6), (1000, 1)]), ("20 minutes", [(0, 35)]), (None, [(0, 35)])])
def test_segments_are_filled_up_to_the_gap(spark, gap, segments):
    """Holes of 5 and of 23 windows; the blocks that holes are looked for in begin anywhere."""
    seconds = [0, 30, 90, 210, 300, 330, 1000 // 30 * 30 + 30]
    metrics = moments(spark, [1_704_067_200 + s for s in seconds])
    filled = series.fill_gaps(series.with_series(metrics), "30 seconds", gap=gap).collect()
    by_segment = {}
    for r in filled:
        by_segment.setdefault(r.segment, []).append((r.window_no, int(r.window_start.timestamp()) - 1_704_067_200))
    want, islands = [], [[seconds[0]]]
    for before, after in zip(seconds, seconds[1:]):
        limit = {"2 minutes": 120, "20 minutes": 1200, None: 10**9}[gap]
        islands.append([after]) if after - before > limit else islands[-1].append(after)
    for k, island in enumerate(islands):
        end = island[-1] if k == len(islands) - 1 else island[-1] + limit
        want.append([(i + 1, s) for i, s in enumerate(range(island[0], end + 1, 30))])
    assert [sorted(by_segment[k]) for k in sorted(by_segment)] == want


def test_silence_until_now_ends_with_the_gap(spark):
    until = F.timestamp_seconds(F.lit(1_704_067_200 + 10**6))
    metrics = moments(spark, [1_704_067_200 + 30 * k for k in range(4)])
    filled = series.fill_gaps(series.with_series(metrics), "30 seconds", until=until, gap="5 minutes")
    assert filled.count() == 4 + 10


def test_summary_knows_all_segments_and_the_last_baseline(spark):
    metrics = moments(spark, [0, 30, 60], 7).unionByName(moments(spark, [10**6 * 30, 10**6 * 30 + 30], 9))
    row = anomalies.summary(metrics, "30 seconds", config=anomalies.DetectorConfig(longest_gap="5 minutes")).first()
    assert (row.batches_processed, row.count_mean, row.count_samples) == (3 + 10 + 2, 9.0, 2)

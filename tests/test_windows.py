"""Window metrics against plain Python over small and random inputs."""

import random
import re
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import windows
from tidewatch.operators.quality import check_contract
from tidewatch.sources.tables import read_events
from tests.conftest import DATA

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def sample(count=600, seconds=3600, seed=5):
    """Events with one user and one page holding a third of the rows, and some nulls."""
    rng = random.Random(seed)
    kinds = ["page_view", "click", "search", "purchase", "add_to_cart"]
    rows = []
    for _ in range(count):
        kind = rng.choice(kinds)
        rows.append((
            round(rng.uniform(0, seconds), 3),
            "hot" if rng.random() < 0.33 else f"u{rng.randint(1, 30)}",
            kind,
            "/hot" if rng.random() < 0.33 else f"/p{rng.randint(1, 12)}",
            rng.choice(["mobile", "desktop", "tablet", None]),
            rng.choice([None, f"s{rng.randint(1, 40)}"]),
            round(rng.uniform(1, 500), 2) if kind == "purchase" and rng.random() < 0.9 else None,
        ))
    return rows


def by_window(rows, width, slide=None):
    slide = slide or width
    groups = defaultdict(list)
    for row in rows:
        start = int(row[0] // slide * slide)
        while start > row[0] - width:
            groups[start].append(row)
            start -= slide
    return groups


def offset(moment):
    return round((moment.replace(tzinfo=timezone.utc) - START).total_seconds())


def half_up(total, count):
    return (2 * total + count) // (2 * count) / 100


def test_tumbling(make_events):
    rows = sample()
    found = {offset(r.window_start): r for r in windows.tumbling_metrics(make_events(rows)).collect()}
    groups = by_window(rows, 60)
    assert set(found) == set(groups)
    for start, members in groups.items():
        row = found[start]
        paid = [round(m[6] * 100) for m in members if m[6] is not None]
        assert offset(row.window_end) == start + 60
        assert row.total_events == len(members)
        assert row.unique_users == len({m[1] for m in members})
        assert row.unique_sessions == len({m[5] for m in members} - {None})
        assert row.purchase_count == sum(m[2] == "purchase" for m in members)
        assert (row.page_views, row.clicks, row.searches) == tuple(
            sum(m[2] == kind for m in members) for kind in ("page_view", "click", "search")
        )
        assert row.total_revenue == sum(paid) / 100
        assert row.avg_order_value == (half_up(sum(paid), len(paid)) if paid else None)


def test_estimated_distincts(make_events):
    events = make_events(sample())
    exact = windows.tumbling_metrics(events, "10 minutes").orderBy("window_start")
    estimated = windows.tumbling_metrics(events, "10 minutes", distinct_error=0.01).orderBy("window_start")
    assert estimated.columns == exact.columns
    for ours, real in zip(estimated.collect(), exact.collect()):
        assert abs(ours.unique_users - real.unique_users) <= 1
        assert abs(ours.unique_sessions - real.unique_sessions) <= 1
        rest = [name for name in exact.columns if not name.startswith("unique")]
        assert [ours[name] for name in rest] == [real[name] for name in rest]


@pytest.mark.parametrize("width, slide", [(300, 30), (120, 60), (60, 60), (3600, 10), (90, 60)])
def test_sliding(make_events, width, slide):
    """Panes with a bit calendar, and the direct way where a calendar does not fit."""
    rows = sample(300)
    events = make_events(rows)
    metrics = windows.sliding_metrics(events, f"{width} seconds", f"{slide} seconds")
    found = {offset(r.window_start): r for r in metrics.collect()}
    groups = by_window(rows, width, slide)
    assert set(found) == set(groups)
    for start, members in groups.items():
        row = found[start]
        assert offset(row.window_end) == start + width
        assert row.event_count == len(members)
        assert row.active_users == len({m[1] for m in members})
        assert row.revenue == sum(round(m[6] * 100) for m in members if m[6] is not None) / 100
        assert row.count_pageview == sum(m[2] == "page_view" for m in members)
        assert row.count_purchase == sum(m[2] == "purchase" for m in members)


def test_sliding_before_1970(make_events):
    rows = [(0.0, "a", "click", "/p", "mobile", "s", None), (45.0, "a", "click", "/p", "mobile", "s", None)]
    events = make_events(rows, start="1969-12-31 23:58:10")
    metrics = windows.sliding_metrics(events)
    direct = windows._sliding_direct(events, "5 minutes", "30 seconds")
    pick = ("window_start", "event_count", "active_users")
    assert sorted(metrics.select(*pick).collect()) == sorted(direct.select(*pick).collect())
    assert metrics.count() == 11


def test_top_pages_orders_and_breaks_ties(make_events):
    views = ["/b"] * 3 + ["/a"] * 3 + ["/c"] * 5 + ["/d"]
    rows = [(float(i), "u", "page_view", page, "mobile", "s", None) for i, page in enumerate(views)]
    rows += [(1.0, "u", "click", "/d", "mobile", "s", None)] * 9
    events = make_events(rows)
    top = windows.top_pages(events, 2).orderBy(F.desc("view_count"), "page").collect()
    assert [(r.page, r.view_count) for r in top] == [("/c", 5), ("/a", 3)]
    assert windows.page_counts(events).count() == 4


def test_devices_and_revenue(make_events):
    rows = sample(400, seed=9)
    events = make_events(rows)
    found = {(offset(r.window_start), r.device): (r.event_count, r.unique_users)
             for r in windows.device_breakdown(events, "10 minutes").collect()}
    expected = defaultdict(list)
    for start, members in by_window(rows, 600).items():
        for member in members:
            expected[start, member[4]].append(member[1])
    assert found == {key: (len(users), len(set(users))) for key, users in expected.items()}

    paid = {offset(r.window_start): r for r in windows.revenue(events, "10 minutes").collect()}
    for start, members in by_window([r for r in rows if r[2] == "purchase" and r[6] is not None], 600).items():
        amounts = [round(m[6] * 100) for m in members]
        row = paid[start]
        assert (row.revenue, row.order_count, row.max_order) == (sum(amounts) / 100, len(amounts), max(amounts) / 100)
        assert row.avg_order == half_up(sum(amounts), len(amounts))


def test_traffic_has_detector_columns(make_events):
    metrics = windows.traffic(make_events(sample(50)), "1 hour", ("device",))
    assert metrics.columns == ["window_start", "device", "event_count", "revenue", "active_users"]


def test_rows_without_time_count_nowhere(make_events):
    events = make_events([(1.0, "u", "click", "/p", "mobile", "s", None)])
    undated = events.withColumn("event_ts", F.lit(None).cast("timestamp"))
    for metric in (windows.tumbling_metrics, windows.sliding_metrics, windows.device_breakdown):
        assert metric(events.unionByName(undated)).collect() == metric(events).collect()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_combine_before_every_shuffle(events):
    """Each shuffle of events sits on a partial aggregate, so hot windows and users arrive combined."""
    # Behind the aggregates: one row per user and pane, or per window start.
    small = re.compile(r"hashpartitioning\((user_id|block)#\d+L?, \d+\)")
    for metric in (windows.tumbling_metrics, windows.device_breakdown, windows.revenue,
                   windows.page_counts, windows.sliding_metrics, windows.traffic):
        lines = plan_of(metric(events)).splitlines()
        for place, line in enumerate(lines):
            if "Exchange hashpartitioning" in line and not small.search(line):
                below = lines[place + 1]
                assert "HashAggregate" in below and ("partial_" in below or "functions=[]" in below), line


def test_top_pages_limits_before_the_shuffle(events):
    plan = plan_of(windows.top_pages(events, 3, "1 hour"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(windows.revenue(read_events(spark, DATA, kinds=("purchase",)), "1 hour"))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "EqualTo(event_type,purchase)" in plan or "In(event_type, [purchase])" in plan


@pytest.mark.parametrize("width, slide", [("5 minutes", "30 seconds"), ("1 hour", "30 seconds"), ("1 day", "10 seconds")])
def test_sliding_copies_no_event_into_its_windows(events, width, slide):
    assert "Expand" not in plan_of(windows.sliding_metrics(events, width, slide))


@pytest.mark.parametrize("start", ["1969-12-31 23:58:10", "2024-01-01 00:00:00"])
@pytest.mark.parametrize("panes", [1, 7, 90, 2500])
def test_sliding_for_any_number_of_panes(make_events, start, panes):
    """Blocks of 1,024 window starts begin inside windows here."""
    rng = random.Random(panes)
    rows = [(rng.random() * 9000, f"u{rng.randrange(4)}", "purchase", "/p", "mobile", "s", 0.5 * rng.randrange(9)) for _ in range(60)]
    events = make_events(rows, start=start)
    found = windows.sliding_metrics(events, f"{panes} seconds", "1 second")
    direct = windows._sliding_direct(events, f"{panes} seconds", "1 second").select(
        "window_start", "window_end", "event_count", "active_users", windows.money(windows.whole_cents("revenue_parts")).alias("revenue")
    )
    assert sorted(map(tuple, found.select(direct.columns).collect())) == sorted(map(tuple, direct.collect()))


def test_bad_amounts_are_left_out_and_small_ones_add_up(make_events):
    amounts = [float("nan"), float("inf"), float("-inf"), 1e300, 1e17, *[0.004] * 1000, 5.0]
    events = make_events([(1.0, f"u{i}", "purchase", "/p", "mobile", "s", a) for i, a in enumerate(amounts)])
    row = windows.tumbling_metrics(events).first()
    assert row.total_revenue == 9.0 and row.avg_order_value == 0.01 and row.purchase_count == len(amounts)
    paid = windows.revenue(events).first()
    assert (paid.revenue, paid.order_count, paid.max_order) == (9.0, 1001, 5.0)
    rules = {r.rule: r.violations for r in check_contract(events).collect()}
    assert rules["amount_is_finite"] == 5

"""Wire decoding, contract checks, deduplication."""

import json

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.dedupe import deduplicate
from tidewatch.operators.parse import parse_events, reject_counts, split_valid
from tidewatch.operators.quality import check_contract
from tidewatch.schema import EVENT_FIELDS
from tidewatch.sources.wire import encode_events, kafka_options
from tidewatch.config import StreamConfig, micros

GOOD = {
    "event_id": "e1", "user_id": "u_1", "event_type": "purchase",
    "timestamp": "2024-01-01T10:00:00.250000+00:00", "page": "/cart", "session_id": "s_1",
    "device": "mobile", "amount": 12.5,
}


@pytest.fixture
def wire(spark):
    def build(*values):
        return spark.createDataFrame([(bytearray(v.encode()),) for v in values], "value binary")

    return build


def test_good_row(wire):
    row = parse_events(wire(json.dumps(GOOD))).first()
    assert [row[name] for name in EVENT_FIELDS] == [GOOD[name] for name in EVENT_FIELDS]
    assert row.event_ts.microsecond == 250000 and str(row.event_date) == "2024-01-01"


def test_bad_rows_and_counts(wire):
    raw = wire(
        json.dumps(GOOD),
        json.dumps(GOOD)[:-1],
        "not json",
        json.dumps({**GOOD, "event_id": None}),
        json.dumps({k: v for k, v in GOOD.items() if k != "user_id"}),
        json.dumps({**GOOD, "event_id": 7, "amount": "much"}),
        json.dumps({**GOOD, "event_id": "e3", "timestamp": "yesterday"}),
        json.dumps({**GOOD, "event_id": "e4", "timestamp": "2024-01-01T10:00:00Z"}),
    )
    rows = {row.event_id: row for row in parse_events(raw).collect()}
    assert set(rows) == {"e1", "7", "e3", "e4"}
    assert rows["7"].amount is None and rows["7"].page == "/cart"
    assert rows["e3"].event_ts is None and rows["e4"].event_ts is not None
    assert reject_counts(raw).first().asDict() == {"valid": 4, "rejected": 4, "without_time": 1}
    valid, rejected = split_valid(raw)
    assert valid.count() + rejected.count() == raw.count()


def test_decoder_runs_once_per_row(wire):
    """The JSON decoder must not be copied into the filters above it."""
    plan = parse_events(wire("{}")).groupBy("device").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_keeps_nulls_and_keys(make_events):
    wire = encode_events(make_events([(1.0, "u_9", "click", "/a", "tablet", "s", None)]))
    row = wire.first()
    assert bytes(row.key) == b"u_9"
    assert json.loads(bytes(row.value))["amount"] is None
    assert parse_events(wire).first().user_id == "u_9"


def test_batch_dedupe_keeps_the_earliest(spark, make_events):
    events = make_events([
        (5.0, "u", "click", "/late", "mobile", "s", None),
        (1.0, "u", "click", "/first", "mobile", "s", None),
        (1.0, "u", "click", "/same-time", "mobile", "s", None),
        (9.0, "v", "click", "/other", "mobile", "s", None),
    ]).withColumn("event_id", F.when(F.col("user_id") == "u", "x").otherwise("y"))
    undated = events.filter("event_id = 'x'").withColumn("event_ts", F.lit(None).cast("timestamp"))
    kept = deduplicate(events.unionByName(undated))
    assert kept.columns == events.columns
    assert sorted((r.event_id, r.page) for r in kept.collect()) == [("x", "/first"), ("y", "/other")]


def test_dedupe_combines_before_the_shuffle(events):
    """A hot id must be reduced in every task before rows travel."""
    plan = deduplicate(events)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange")


def test_contract(make_events):
    good = [
        (float(i), "u", "page_view", "/a", "mobile", "s", None) for i in range(8)
    ] + [(20.0, "u", "purchase", "/a", "desktop", "s", 3.0)]
    clean = {r.rule: r.violations for r in check_contract(make_events(good)).collect()}
    assert set(clean.values()) == {0}
    bad = make_events(good + [
        (21.0, "u", "purchase", "/a", "mobile", "s", 0.0),
        (22.0, "u", "purchase", "/a", "mobile", "s", None),
        (23.0, "u", "click", "/a", "mobile", "s", 1.0),
        (24.0, "u", "explode", "/a", "phone", None, None),
    ])
    bad = bad.unionByName(bad.limit(1)).unionByName(
        bad.filter("event_id = '0'").withColumn("event_id", F.lit("z")).withColumn("timestamp", F.lit("soon"))
        .withColumn("event_ts", F.lit(None).cast("timestamp"))
    )
    found = {r.rule: r.violations for r in check_contract(bad).collect()}
    expected = {
        "purchase_has_amount": 2, "other_has_no_amount": 1, "event_type_known": 1, "device_known": 1,
        "session_id_present": 1, "event_id_unique": 1, "timestamp_is_iso": 1, "timestamp_readable": 1,
    }
    assert {rule: found[rule] for rule in expected} == expected
    # Three purchases against ten views, copies included: no longer more than three to one.
    assert found["views_outnumber_purchases"] == 0
    more = bad.unionByName(bad.filter("event_type = 'purchase'"))
    assert {r.rule: r.violations for r in check_contract(more).collect()}["views_outnumber_purchases"] == 1


def test_source_options_and_environment(monkeypatch):
    monkeypatch.setenv("KAFKA_BROKERS", "b:1")
    monkeypatch.setenv("BATCH_SECS", "7")
    config = StreamConfig.from_env(topic="t")
    assert (config.brokers, config.micro_batch_seconds, config.topic) == ("b:1", 7, "t")
    options = kafka_options(config)
    assert options["subscribe"] == "t" and options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "true" and options["maxOffsetsPerTrigger"] == "10000"
    skipping = kafka_options(StreamConfig(fail_on_data_loss=False, max_offsets_per_trigger=None))
    assert skipping["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" not in skipping


@pytest.mark.parametrize("text, expected", [("30 seconds", 30_000_000), ("1 minute", 60_000_000), ("2 hours", 7_200_000_000)])
def test_spans(text, expected):
    assert micros(text) == expected


def test_unreadable_span():
    with pytest.raises(ValueError):
        micros("a while")

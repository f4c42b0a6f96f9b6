"""Settings shared by the batch operators and the streaming job.

Every operator also takes these as parameters; the classes only bundle the defaults.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

# Event kinds, devices and names that the data contract prescribes.
EVENT_TYPES = ("page_view", "click", "search", "purchase", "add_to_cart")
DEVICES = ("mobile", "desktop", "tablet")
SLIDING_COUNT_TYPES = ("page_view", "click", "purchase", "search")


@dataclass(frozen=True)
class WindowConfig:
    """Event-time window lengths (fixed values)."""

    short: str = "1 minute"
    long: str = "5 minutes"
    slide: str = "30 seconds"
    watermark: str = "10 seconds"
    top_n: int = 10


@dataclass(frozen=True)
class DetectorConfig:
    """Anomaly thresholds (fixed values). Shares are fractions of the rolling mean."""

    window_size: int = 20
    min_samples: int = 10
    z_score: float = 2.5
    spike_multiple: float = 3.0
    drop: float = 0.40
    revenue_drop: float = 0.30
    # Severity steps.
    spike_high_z: float = 4.0
    drop_critical: float = 0.70
    drop_high: float = 0.50
    revenue_critical: float = 0.50
    # An empty window is an alert from the window after this one.
    zero_grace: int = 3
    # A hole longer than this ends a segment of a series: it is filled with empty windows up to here, and what
    # follows has a baseline of its own. None fills every hole.
    longest_gap: str | None = "7 days"


@dataclass(frozen=True)
class StreamConfig:
    """Source, trigger and table settings of the streaming job."""

    app_name: str = "tidewatch"
    source_format: str = "kafka"
    brokers: str = "localhost:9092"
    topic: str = "user-events"
    starting_offsets: str = "latest"
    # Offsets of a micro-batch; None takes all there are.
    max_offsets_per_trigger: int | None = 10_000
    # Stop when the topic no longer has offsets that were not read yet, instead of skipping them.
    fail_on_data_loss: bool = True
    # Files of the landed tables that a micro-batch of the streams behind them takes; None takes all there are.
    # One landing batch writes a file for each date, so a limit below that hands on its rows out of time
    # order: set it only with watermarks that cover the span of a landing batch.
    max_files_per_trigger: int | None = None
    # Format of the tables, for readers and writers that Spark knows by name.
    table_format: str = "parquet"
    # How far an event's time may lie ahead of the clock that landed it. Events beyond that stay in the
    # landed table and go to the table ``misdated`` instead of the streams with watermarks.
    clock_skew: str = "1 hour"
    source_options: dict[str, str] = field(default_factory=dict)
    micro_batch_seconds: int = 5
    checkpoint_dir: str | None = None
    base_path: str | None = None
    # Shuffle and state partitions; None keeps what the session says.
    shuffle_partitions: int | None = None
    # How long the cleaning query recognises copies and waits for late events. Its own
    # watermark: the metric queries keep the shorter one of their windows. What comes later is in the
    # landed table all the same.
    dedupe_delay: str = "10 minutes"
    # Files of the archive per micro-batch and date; None leaves one per task with rows.
    archive_files: int | None = None
    # Days before the newest one whose files stay as they were streamed when the job starts; older dates are compacted
    # then. None compacts nothing.
    open_days: int | None = 2
    # Files older than this leave the logs of the file sinks; longer than the job runs between two starts and its open days. None keeps all.
    sink_retention: str | None = None
    # First-pass buckets of the stream dedupe; 1 switches the pre-pass off. An event without
    # copies costs the same whatever the number, and a hot one is split over this many.
    dedupe_spread: int = 1024
    summary_every: int = 10
    # How long after its end and the watermark's delay an empty window is reported while no event arrives; for live
    # runs. It has to cover what a window takes from there to the detector: a few triggers. A checkpoint of the alerts belongs to one kind of run.
    outage_patience: str | None = "1 minute"
    windows: WindowConfig = field(default_factory=WindowConfig)
    detector: DetectorConfig = field(default_factory=DetectorConfig)

    @staticmethod
    def from_env(**overrides) -> "StreamConfig":
        """Settings with environment overrides; keyword arguments win over both."""
        found = {
            "brokers": os.environ.get("KAFKA_BROKERS"),
            "topic": os.environ.get("KAFKA_TOPIC"),
            "checkpoint_dir": os.environ.get("CHECKPOINT_DIR"),
            "base_path": os.environ.get("DELTA_PATH"),
            "micro_batch_seconds": os.environ.get("BATCH_SECS"),
            "max_offsets_per_trigger": os.environ.get("MAX_OFFSETS"),
            "fail_on_data_loss": os.environ.get("FAIL_ON_DATA_LOSS"),
            "table_format": os.environ.get("TABLE_FORMAT"),
        }
        values = {name: value for name, value in found.items() if value}
        for name in {"micro_batch_seconds", "max_offsets_per_trigger"} & values.keys():
            # 0 offsets means no limit.
            values[name] = int(values[name]) or None
        if "fail_on_data_loss" in values:
            values["fail_on_data_loss"] = values["fail_on_data_loss"].lower() != "false"
        return StreamConfig(**{**values, **overrides})


_UNIT_MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(span: str) -> int:
    """Length of a span such as ``"30 seconds"`` in microseconds."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", span.lower())
    if not match or match.group(2) not in _UNIT_MICROS:
        raise ValueError(f"cannot read the time span {span!r}")
    return int(match.group(1)) * _UNIT_MICROS[match.group(2)]

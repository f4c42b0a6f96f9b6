"""Spark session settings and the shared folder for work tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

from tidewatch.config import StreamConfig

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings the operators rely on: one time zone for every reader, and a state
# store that keeps large keyed state off the heap, in small write buffers, as each partition has one. Nor does a store
# reserve disk ahead of its rows, 4 MB each, and what it writes is compressed well.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "16",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}

STATIC = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(config: StreamConfig | None = None, master: str | None = None, **extra) -> SparkSession:
    """A session set up for this package; ``extra`` holds further Spark settings."""
    config = config or StreamConfig()
    builder = SparkSession.builder.appName(config.app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**STATIC, **RUNTIME, **extra}.items():
        builder = builder.config(name, value)
    if config.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(config.shuffle_partitions))
    if config.checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", config.checkpoint_dir)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings to a session somebody else built."""
    for name, value in RUNTIME.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fixed folder below the cluster's shared ``spark.checkpoint.dir``.

    On a single machine (``local[n]``) a new temporary folder stands in for a missing setting.
    Executors elsewhere could not see such a folder, so a cluster has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors can reach")
    if not shared:
        shared = tempfile.mkdtemp(prefix="tidewatch-")
    return f"{shared.rstrip('/')}/tidewatch/{name}"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this name below the shared one."""
    return f"{shared_dir(spark, name)}-{uuid.uuid4().hex}"


_REACHABLE: set[str] = set()

_PROBE = """
def probe(batches):
    import importlib.util, pyarrow
    for batch in batches:
        found = importlib.util.find_spec(name) is not None
        yield pyarrow.RecordBatch.from_pydict({"found": [found]})
"""


def ship_package(spark: SparkSession) -> None:
    """Makes sure that Python workers can import this package; asked once for each application.

    Where they cannot, the package goes to them as an archive, by Spark's own way of shipping code.
    """
    app = spark.sparkContext.applicationId
    if app in _REACHABLE:
        return
    # Defined outside of the package, so that it travels by value.
    scope = {"name": __package__}
    exec(_PROBE, scope)
    if not spark.range(1).mapInArrow(scope["probe"], "found boolean").first().found:
        root = Path(__file__).resolve().parent
        # The driver serves this file to executors, also to those that come later, so it stays.
        archive = f"{tempfile.mkdtemp(prefix='tidewatch-code-')}/{__package__}.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for file in root.rglob("*.py"):
                packed.write(file, str(file.relative_to(root.parent)))
        spark.sparkContext.addPyFile(archive)
    _REACHABLE.add(app)


@contextmanager
def state_partitions(spark: SparkSession, count: int | None):
    """Shuffle partitions for streams started inside the block.

    A stream copies the session settings when it starts and keeps this number for the life
    of its checkpoint, so it is set only around ``start()``.
    """
    if not count:
        yield
        return
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

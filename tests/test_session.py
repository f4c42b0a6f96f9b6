"""Shipped code and work tables."""

import subprocess
import sys
from pathlib import Path

import pytest

from tidewatch.sources.tables import Scratch

ROOT = Path(__file__).resolve().parent.parent


def test_scratch_tables_go_with_their_computation(spark):
    with Scratch(spark, "scratch") as scratch:
        table = scratch.store(spark.range(10), "numbers")
        assert table.count() == 10
        folder = Path(scratch.path.removeprefix("file://"))
        assert folder.is_dir()
    assert not folder.exists()
    with pytest.raises(ZeroDivisionError), Scratch(spark, "scratch") as scratch:
        scratch.store(spark.range(1), "n")
        folder = Path(scratch.path.removeprefix("file://"))
        1 / 0
    assert not folder.exists()


def test_workers_get_the_package_where_they_lack_it(tmp_path):
    """A driver that runs elsewhere and has the package on its own path only."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from tidewatch.session import build_session, ship_package
spark = build_session(master="local[1]", **{{"spark.ui.enabled": "false"}})
ship_package(spark)
from tidewatch.functions import measures
print("answer", spark.range(3).rdd.map(lambda x: measures.count_name("page_view")).collect()[2])
"""
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "answer count_pageview" in done.stdout, done.stderr[-2000:]

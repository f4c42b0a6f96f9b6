"""Runs the streaming job: ``python -m tidewatch``, or ``spark-submit run.py`` on a cluster."""

from __future__ import annotations

import logging

from tidewatch.config import StreamConfig
from tidewatch.session import build_session
from tidewatch.streaming.job import start_all


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    config = StreamConfig.from_env()
    start_all(build_session(config), config).await_any()


if __name__ == "__main__":
    main()

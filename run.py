"""Entry script for ``spark-submit``."""

from tidewatch.__main__ import main

main()

"""Launcher for spark-submit: ``spark-submit --py-files spendlens.zip spendlens_submit.py --help``
(the package must be importable on the driver and executors)."""

import sys

from spendlens.plans.cli import main

if __name__ == "__main__":
    sys.exit(main())

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendlens import config as C  # noqa: E402
from spendlens.session import local_session, shared_folder  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    s = local_session(
        4,
        shuffle_partitions=8,
        app="spendlens-tests",
        warehouse_dir=tempfile.mkdtemp(prefix="spendlens-warehouse-"),
    )
    shared_folder(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cfg() -> C.JobConfig:
    """A small run configuration for hand-written rows."""
    return C.JobConfig(
        apps=("APP_A", "APP_B", "APP_C", "OTHER"),
        window=C.ReportWindow(start=dt.date(2021, 1, 1), as_of=dt.date(2023, 6, 10)),
        tiers=C.RoyaltyTiers(tier_a="APP_A", tier_b="APP_B", tier_c="APP_C"),
    )


def D(x) -> Decimal:
    return Decimal(str(x))

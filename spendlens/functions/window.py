"""Reporting-window classification of dated rows (X16 as a column expression)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ReportWindow

BEFORE_START = "before_start"
IN_WINDOW = "in_window"
LAGGED_OUT = "lagged_out"
NOT_YET = "not_yet"
UNDATED = "undated"


def mmp_window_class(date: Column, window: ReportWindow) -> Column:
    """MMP rows: in the window up to ``end``; rows after ``end`` wait for the report delay."""
    return (
        F.when(date.isNull(), UNDATED)
        .when(date < F.lit(window.start), BEFORE_START)
        .when(date <= F.lit(window.end), IN_WINDOW)
        .when(date < F.lit(window.as_of), LAGGED_OUT)
        .otherwise(NOT_YET)
    )


def skan_window_class(date: Column, window: ReportWindow) -> Column:
    """SKAN rows: in the window up to the day before the run date (no report delay)."""
    return (
        F.when(date.isNull(), UNDATED)
        .when(date < F.lit(window.start), BEFORE_START)
        .when(date < F.lit(window.skan_end_exclusive), IN_WINDOW)
        .otherwise(NOT_YET)
    )

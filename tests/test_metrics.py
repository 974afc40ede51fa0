"""Decimals: exact at every scale allowed, refused beyond, never NULL by overflow."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import types as T
from rows import FACT_SCHEMA, fact_row

from spendlens import config as C
from spendlens.functions.metrics import clamp_nonnegative, normalize_decimals
from spendlens.operators.rollup import campaign_rollup


def _fact(spark, dtype, **measures):
    fields = [T.StructField(f.name, dtype if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in FACT_SCHEMA]
    rows = [fact_row(app="APP_A", **measures), fact_row(app="APP_A", **measures)]
    return spark.createDataFrame(rows, T.StructType(fields))


def test_fine_scales_lose_no_digit(spark, cfg):
    x = Decimal("1.123456789")
    fact = _fact(spark, T.DecimalType(20, 9), USER_QTY=Decimal(1), EXPENSE_AMT=x, LTV_365_LASTEST_VAL=x, REVS_DAY_001_AMT=x)
    r = campaign_rollup(fact, cfg).collect()[0]
    assert r.SPEND == 2 * x
    assert r.IAP_LTV == r.IAP_REVS_DAY_001_AMT == 2 * x * Decimal("0.616")


def test_finer_scales_are_refused(spark, cfg):
    with pytest.raises(ValueError, match="scale"):
        campaign_rollup(_fact(spark, T.DecimalType(20, 10), USER_QTY=Decimal(1)), cfg)
    with pytest.raises(ValueError, match="scale"):
        normalize_decimals(spark.sql("SELECT CAST(1 AS DECIMAL(38,13)) AS SPEND"), ["SPEND"])


def test_totals_past_64_bits_of_the_smallest_unit(spark, cfg):
    """9.2 trillion at scale 6 is past what a 64-bit count of millionths holds."""
    x = Decimal("9000000000000.000001")
    fact = _fact(spark, T.DecimalType(20, 6), USER_QTY=Decimal(1), EXPENSE_AMT=x)
    assert campaign_rollup(fact, cfg).collect()[0].SPEND == 2 * x


def test_without_ansi_the_job_fails_instead_of_publishing_zero(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        wide = spark.sql("SELECT CAST('99999999999999999999999999.00' AS DECIMAL(38,2)) AS SPEND")
        with pytest.raises(RuntimeError, match="ansi"):
            clamp_nonnegative(normalize_decimals(wide, ["SPEND"]), ["SPEND"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW|cannot be represented"):
        normalize_decimals(wide, ["SPEND"]).collect()


def test_metric_type():
    assert C.METRIC_DECIMAL.scale == C.MAX_INPUT_SCALE + 3

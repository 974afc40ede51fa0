"""X6: campaign detail merge (fact roll-up + install-level subscription LTV)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.metrics import normalize_decimals


def merge_details(fact_rollup: DataFrame, sub_rollup: DataFrame) -> DataFrame:
    """Left join on the campaign grain (K6), missing subscription LTV as 0, plus TOTAL_LTV.

    A NULL key never matches (a NULL source type keeps its fact row, without subscription
    LTV). TOTAL_LTV = IAP + AD + SUB is NULL when IAP or AD is NULL.

    Both inputs are aggregates hash-partitioned on K6 already, so the join plans without a
    further exchange on either side.
    """
    joined = fact_rollup.join(
        sub_rollup.select(*C.K6, "SUB_LTV"), on=list(C.K6), how="left"
    )
    sub = F.coalesce(F.col("SUB_LTV"), F.lit(0))
    out = joined.select(
        *C.K6,
        *[m for m in C.METRICS_RAW if m not in ("SUB_LTV", "TOTAL_LTV")],
        sub.alias("SUB_LTV"),
        (F.col("IAP_LTV") + F.col("AD_LTV") + sub).alias("TOTAL_LTV"),
    )
    return normalize_decimals(out, C.METRICS_RAW)

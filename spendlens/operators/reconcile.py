"""X9: iOS organic as a residual, the four-branch union, and the non-negative clamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.metrics import clamp_sql, normalize_decimals, sum_metrics
from ..functions.rates import sql_col, sql_str

_PART = "_PART"


def residual_parts(
    details: DataFrame, enriched: DataFrame, remainder: DataFrame, cfg: C.JobConfig
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows behind the residual: iOS MMP total (source types MK/US), iOS MMP paid (MK
    rows SKAN does not report) and every enriched SKAN row."""
    ios = F.col(C.MARKET) == F.lit(C.IOS_MARKET)
    total = details.where(ios & F.col(C.SOURCE_TYPE).isin(list(cfg.residual_total_types)))
    paid = remainder.where(ios & (F.col(C.SOURCE_TYPE) == F.lit(cfg.residual_paid_type)))
    return total, paid, enriched


def part_sums(df: DataFrame, prefix: str) -> DataFrame:
    """Sums of every campaign metric per app, market and day, prefixed (one residual part)."""
    out = df.groupBy(*C.K3).agg(*sum_metrics(C.METRICS_RAW, prefix))
    return normalize_decimals(out, [prefix + m for m in C.METRICS_RAW])


def _tagged(df: DataFrame, tag: str, drop_null_keys: bool) -> DataFrame:
    if drop_null_keys:
        df = df.where(" AND ".join(f"{sql_col(k)} IS NOT NULL" for k in C.K3))
    return df.selectExpr(
        *[sql_col(k) for k in C.K3],
        f"{sql_str(tag)} AS {_PART}",
        *[sql_col(m) for m in C.METRICS_RAW],
    )


def organic_residual(
    details: DataFrame, enriched: DataFrame, remainder: DataFrame, cfg: C.JobConfig
) -> DataFrame:
    """Signed iOS organic per app, market and day: total - paid - SKAN, before clamping.

    total = iOS MMP rows typed MK or US; paid = iOS MK rows SKAN does not report; SKAN =
    every enriched SKAN row. Only groups with a total row yield a residual; paid and SKAN
    sums count as 0 when missing, the total does not (NULL stays NULL).

    One shuffle: the three parts are tagged, unioned and aggregated once on K3 with signed
    sums (partial aggregation first), instead of three aggregates and two joins.
    Part rows with a NULL key are dropped because a join would never match them.
    """
    total, paid, skan = residual_parts(details, enriched, remainder, cfg)
    parts = (
        _tagged(total, "T", drop_null_keys=False)
        .unionByName(_tagged(paid, "P", drop_null_keys=True))
        .unionByName(_tagged(skan, "S", drop_null_keys=True))
    )
    # One signed sum per metric (total values added, paid and SKAN values subtracted; NULLs
    # skipped, so missing parts count as 0) and a count of non-NULL total values, which keeps
    # an all-NULL total NULL: 24 decimal sums and 24 counts instead of 72 decimal sums.
    aggs = [F.expr(f"count(CASE WHEN {_PART} = 'T' THEN 1 END) AS _TOTAL_ROWS")]
    for m in C.METRICS_RAW:
        c = sql_col(m)
        aggs.append(F.expr(f"sum(CASE WHEN {_PART} = 'T' THEN {c} ELSE -{c} END) AS _D_{m}"))
        aggs.append(F.expr(f"count(CASE WHEN {_PART} = 'T' THEN {c} END) AS _N_{m}"))
    grouped = parts.groupBy(*C.K3).agg(*aggs).where(F.col("_TOTAL_ROWS") > 0)
    out = grouped.selectExpr(
        *[sql_col(k) for k in C.K3],
        f"{sql_str(C.ORGANIC_SOURCE_TYPE)} AS {sql_col(C.SOURCE_TYPE)}",
        f"{sql_str(C.MMP_SOURCE)} AS {sql_col(C.SOURCE)}",
        f"{sql_str(C.ORGANIC)} AS {sql_col(C.CHANNEL)}",
        f"{sql_str(C.ORGANIC)} AS {sql_col(C.PROMOTION)}",
        *[f"CASE WHEN _N_{m} > 0 THEN _D_{m} END AS {sql_col(m)}" for m in C.METRICS_RAW],
    )
    return normalize_decimals(out, C.METRICS_RAW)


def assemble_campaign(
    details: DataFrame,
    enriched: DataFrame,
    remainder: DataFrame,
    cfg: C.JobConfig,
    clamp: bool = True,
) -> DataFrame:
    """The complete campaign table: iOS organic residual, iOS MMP non-organic campaigns
    SKAN does not report, SKAN campaigns, and all Google campaigns; every metric clamped
    to be non-negative; INSTALL_NUM renamed INSTALL (one final projection)."""
    residual = organic_residual(details, enriched, remainder, cfg)
    ios_mmp = remainder.where(
        (F.col(C.MARKET) == F.lit(C.IOS_MARKET))
        & (F.col(C.SOURCE_TYPE) != F.lit(C.ORGANIC_SOURCE_TYPE))
    )
    google = details.where(F.col(C.MARKET) == F.lit(C.GOOGLE_MARKET)).withColumn(
        C.SOURCE, F.lit(C.MMP_SOURCE)
    )
    cols = [*C.CAMPAIGN_KEYS, *C.METRICS_RAW]
    union = (
        residual.select(*cols)
        .unionByName(ios_mmp.select(*cols))
        .unionByName(enriched.select(*cols))
        .unionByName(google.select(*cols))
    )
    renamed = {C.INSTALL_RAW: C.INSTALL}
    if clamp:
        metric_exprs = [clamp_sql(m, renamed.get(m)) for m in C.METRICS_RAW]
    else:
        metric_exprs = [f"{sql_col(m)} AS {sql_col(renamed.get(m, m))}" for m in C.METRICS_RAW]
    return union.selectExpr(*[sql_col(k) for k in C.CAMPAIGN_KEYS], *metric_exprs)

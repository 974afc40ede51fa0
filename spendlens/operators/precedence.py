"""X8: source precedence. Where SKAN reports a campaign it wins; MMP supplies its spend.

SKAN only reports iOS, so only iOS rows of the MMP campaign details meet the SKAN roll-up,
in one FULL OUTER join on K5 (one shuffle of each side) that carries the three metrics SKAN
has:

* a row with a SKAN side is an enriched SKAN campaign: SKAN metrics, plus the MMP spend
  and source type of the matched row (spend 0 and source type MK when unmatched);
* a row with only an MMP side is an MMP campaign SKAN does not report (the anti join).

Details of other markets have no SKAN side; they join the remainder unchanged.

The SKAN roll-up is unique on K5, so every iOS MMP row appears exactly once; a SKAN campaign
matching several MMP source types appears once per match (the published job's fan-out).
NULL keys never match, so NULL-key rows of either side stay unmatched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rates import sql_col, sql_str
from ..session import Scratch

_HAS_MMP = "_HAS_MMP"
_HAS_SKAN = "_HAS_SKAN"
_SKAN = "SKAN__"
#: what a SKAN roll-up measures; its other metrics are 0
SKAN_METRICS = (C.INSTALL_RAW, "IAP_LTV", "TOTAL_LTV")


def _is_ios() -> Column:
    return F.col(C.MARKET) == F.lit(C.IOS_MARKET)


def precedence_join(details: DataFrame, skan: DataFrame) -> DataFrame:
    """iOS MMP details FULL OUTER JOIN SKAN roll-up on K5, SKAN metrics prefixed."""
    mmp = details.where(_is_ios()).select(*C.K6, *C.METRICS_RAW, F.lit(True).alias(_HAS_MMP))
    sk = skan.select(
        *C.K5,
        *[F.col(m).alias(_SKAN + m) for m in SKAN_METRICS],
        F.lit(True).alias(_HAS_SKAN),
    )
    return mmp.join(sk, on=list(C.K5), how="full_outer")


def enriched_rows(joined: DataFrame, collapse: bool = False) -> DataFrame:
    """SKAN campaigns with the matched MMP spend and source type (defaults when unmatched).

    ``collapse``: one row per SKAN campaign also where several MMP rows match it, with their
    spends added and the source type of the largest (of equal ones the first by name)."""
    rows = joined.where(F.col(_HAS_SKAN))
    if collapse:
        rows = rows.groupBy(*C.K5).agg(
            F.sum("SPEND").cast(C.METRIC_DECIMAL).alias("SPEND"),
            F.min_by(C.SOURCE_TYPE, F.struct(-F.coalesce("SPEND", F.lit(0)), C.SOURCE_TYPE)).alias(C.SOURCE_TYPE),
            *[F.first(_SKAN + m).alias(_SKAN + m) for m in SKAN_METRICS],
        )
    zero = f"CAST(0 AS DECIMAL({C.METRIC_DECIMAL.precision},{C.METRIC_DECIMAL.scale}))"
    return rows.selectExpr(
        *[sql_col(k) for k in (C.APP, C.MARKET)],
        f"{sql_str(C.SKAN_SOURCE)} AS {sql_col(C.SOURCE)}",
        f"coalesce({sql_col(C.SOURCE_TYPE)}, {sql_str(C.SKAN_DEFAULT_SOURCE_TYPE)}) AS {sql_col(C.SOURCE_TYPE)}",
        *[sql_col(k) for k in (C.CHANNEL, C.PROMOTION, C.DATE)],
        "coalesce(SPEND, 0) AS SPEND",
        *[
            f"{sql_col(_SKAN + m) if m in SKAN_METRICS else zero} AS {sql_col(m)}"
            for m in C.METRICS_RAW
            if m != "SPEND"
        ],
    )


def remainder_rows(joined: DataFrame, details: DataFrame) -> DataFrame:
    """MMP campaigns SKAN does not report, tagged Non-SKAN: unmatched iOS rows of the join, and
    every row of ``details`` in another market (or none)."""
    cols = [*C.K6, *C.METRICS_RAW]
    unmatched = joined.where(F.col(_HAS_MMP) & F.col(_HAS_SKAN).isNull()).select(*cols)
    elsewhere = details.where(~F.coalesce(_is_ios(), F.lit(False))).select(*cols)
    return unmatched.unionByName(elsewhere).withColumn(C.SOURCE, F.lit(C.MMP_SOURCE))


def fanout_rows(joined: DataFrame) -> DataFrame:
    """SKAN campaigns (K5) of a precedence join that match more than one MMP row."""
    return (
        joined.where(F.col(_HAS_SKAN) & F.col(_HAS_MMP))
        .groupBy(*C.K5)
        .agg(F.count(F.lit(1)).alias("MATCHES"))
        .where(F.col("MATCHES") > 1)
    )


#: campaigns written out in the message; all of them are in the relation it names
SHOWN = 20


class FanOutError(Exception):
    """Raised under ``fanout="error"`` when SKAN campaigns match several MMP rows.

    ``total`` counts them, ``path`` is the Parquet relation of all, ``shown`` the first by key."""

    def __init__(self, total: int, shown: list[Row], path: str):
        self.total, self.shown, self.path = total, shown, path
        keys = ", ".join(f"{r[C.APP]}/{r[C.CHANNEL]}/{r[C.PROMOTION]}/{r[C.DATE]} x{r['MATCHES']}" for r in shown)
        super().__init__(
            f"{total} SKAN campaign(s) match several MMP source types; all are in {path}."
            f" First {len(shown)} of {total}: {keys}"
        )


def assert_no_fanout(joined: DataFrame) -> None:
    """Raise FanOutError if any SKAN campaign matches several MMP rows."""
    scratch = Scratch(joined.sparkSession)
    found = scratch.write(fanout_rows(joined), "fanout")
    total = found.count()
    if total:
        raise FanOutError(total, found.orderBy(*C.K5).limit(SHOWN).collect(), scratch.path("fanout"))
    scratch.release()

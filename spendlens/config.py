"""Job configuration: key sets, the metric list, the reporting window and the share tables.

Everything a run depends on is an explicit value here; operators never read a clock or a
global. Application names are deployment configuration (`JobConfig.apps`, `RoyaltyTiers`),
so the same code serves production catalogs and the test fixtures.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Keys
# --------------------------------------------------------------------------------------
APP = "APPLICATION_FAMILY_NAME"
MARKET = "MARKET_CD"
SOURCE_TYPE = "USER_SOURCE_TYPE_CD"
CHANNEL = "CHANNEL_NAME"
PROMOTION = "PROMOTION_NAME"
DATE = "CALENDAR_DT"
SOURCE = "SOURCE"

#: campaign grain
K6 = (APP, MARKET, SOURCE_TYPE, CHANNEL, PROMOTION, DATE)
#: campaign grain without the source type (the SKAN side has none)
K5 = (APP, MARKET, CHANNEL, PROMOTION, DATE)
#: app / market / day grain of the organic residual
K3 = (APP, MARKET, DATE)
#: channel grain of the published channel table
KCH = (APP, MARKET, SOURCE, SOURCE_TYPE, CHANNEL, DATE)
#: game grain of the regression gate
KG = (APP, MARKET, SOURCE)
#: identity of one user of one application (projection history, installs)
USER_KEY = ("ACCOUNT_ID", "USER_ID", "APPLICATION_CD")

#: output column order of the campaign table
CAMPAIGN_KEYS = (APP, MARKET, SOURCE, SOURCE_TYPE, CHANNEL, PROMOTION, DATE)

# --------------------------------------------------------------------------------------
# Metrics (one ordered list; the order is the published column order)
# --------------------------------------------------------------------------------------
REVENUE_DAYS = (1, 3, 7, 14, 28)
RETENTION_DAYS = (1, 3, 7)
REVENUE_KINDS = ("IAP", "AD", "SUB")

RETENTION_METRICS = tuple(f"RETENTION_DAY_{d:03d}_QTY" for d in RETENTION_DAYS)
REVENUE_METRICS = tuple(
    f"{kind}_REVS_DAY_{d:03d}_AMT" for d in REVENUE_DAYS for kind in REVENUE_KINDS
)
LTV_METRICS = ("IAP_LTV", "AD_LTV", "SUB_LTV", "TOTAL_LTV")

#: install count is called INSTALL_NUM until the campaign table is complete, INSTALL after
INSTALL_RAW = "INSTALL_NUM"
INSTALL = "INSTALL"

METRICS_RAW = ("SPEND", INSTALL_RAW, *RETENTION_METRICS, *REVENUE_METRICS, *LTV_METRICS)
METRICS = ("SPEND", INSTALL, *RETENTION_METRICS, *REVENUE_METRICS, *LTV_METRICS)

#: published as 32-bit float / 32-bit int in the legacy schema
MONEY_METRICS = ("SPEND", *REVENUE_METRICS, *LTV_METRICS)
COUNT_METRICS = (INSTALL, *RETENTION_METRICS)

#: every decimal metric is cast back to this type after each roll-up, so repeated sums
#: and differences never exceed precision 38 (Spark would otherwise drop scale digits)
METRIC_DECIMAL = T.DecimalType(36, 12)
#: digits of scale an input measure may have (a share rate adds three)
MAX_INPUT_SCALE = 9

# --------------------------------------------------------------------------------------
# Revenue shares kept by the publisher, as used by the published job.
# Keys are licensing tiers; which application plays which tier is configuration.
# "default" applies to every other application. None means the gross value is kept.
# --------------------------------------------------------------------------------------
IAP_SHARE = {"tier_a": "0.616", "tier_b": "0.525", "tier_c": "0.546", "default": "0.7"}
AD_SHARE = {"tier_a": "0.88", "tier_b": "0.75", "tier_c": "0.78", "default": None}
#: subscriptions while the store keeps 30 % (first subscription year)
SUB_SHARE_FULL_FEE = {"tier_a": "0.616", "tier_b": "0.525", "default": "0.7"}
#: subscriptions while the store keeps 15 % (after a year; all of Google Play from the cut-over)
SUB_SHARE_REDUCED_FEE = {"tier_a": "0.748", "tier_b": "0.638", "default": "0.85"}
#: Google Play subscription fee cut-over of the published job
GOOGLE_REDUCED_FEE_FROM = dt.date(2022, 1, 1)
#: iOS subscriptions older than this many days before the run date get the reduced fee
IOS_REDUCED_FEE_AFTER_DAYS = 366
#: source types counted as paid; the rest fold into ORGANIC
PAID_SOURCE_TYPES = ("MM", "MK", "MC")
#: channel names of SKAN-attributed campaigns renamed to their MMP channel
CHANNEL_ALIAS = (("SKANUAC", "ADWORDS"), ("SKANFB", "SGNFB"))
EXCLUDED_CHANNEL_PATTERN = "%UNTRUSTED%"
CAMPAIGN_TYPE = "New Installs"
IOS_MARKET = "IT"
GOOGLE_MARKET = "GO"
MARKETS = (IOS_MARKET, GOOGLE_MARKET)
ORGANIC = "ORGANIC"
SKAN_SOURCE = "SKAN"
MMP_SOURCE = "Non-SKAN"
#: residual scope: total = these iOS source types, paid = MK, the residual row is typed US
RESIDUAL_TOTAL_TYPES = ("MK", "US")
RESIDUAL_PAID_TYPE = "MK"
ORGANIC_SOURCE_TYPE = "US"
#: source type given to SKAN campaigns with no MMP spend row
SKAN_DEFAULT_SOURCE_TYPE = "MK"
REPORT_DELAY_DAYS = 3
DEFAULT_START = dt.date(2021, 1, 1)


def _dec(value: str | None) -> Decimal | None:
    return None if value is None else Decimal(value)


@dataclass(frozen=True)
class ReportWindow:
    """The dates one run covers (driver-side value object; no row work).

    The MMP side covers ``start .. end`` inclusive, where ``end = as_of - delay_days``.
    The SKAN side covers ``start <= d < as_of`` (it is not lagged, as in the published job).
    iOS subscription revenue dated before ``as_of - 366 days`` gets the reduced store fee.
    """

    start: dt.date
    as_of: dt.date
    delay_days: int = REPORT_DELAY_DAYS

    @property
    def end(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.delay_days)

    @property
    def skan_end_exclusive(self) -> dt.date:
        return self.as_of

    @property
    def ios_reduced_fee_before(self) -> dt.date:
        return self.as_of - dt.timedelta(days=IOS_REDUCED_FEE_AFTER_DAYS)

    def shifted(self, days: int) -> ReportWindow:
        return replace(self, as_of=self.as_of + dt.timedelta(days=days))

    def stamp(self) -> str:
        """Run-date stamp used in snapshot paths (``YYYY-MM-DD``)."""
        return self.as_of.strftime("%Y-%m-%d")


@dataclass(frozen=True)
class RoyaltyTiers:
    """Which application plays which licensing tier of the share tables."""

    tier_a: str | None = None
    tier_b: str | None = None
    tier_c: str | None = None

    def apps_for(self, table: dict[str, str | None]) -> tuple[tuple[str, Decimal | None], ...]:
        out = []
        for tier in ("tier_a", "tier_b", "tier_c"):
            app = getattr(self, tier)
            if app is not None and tier in table:
                out.append((app, _dec(table[tier])))
        return tuple(out)


@dataclass(frozen=True)
class JobConfig:
    """Every parameter of one attribution run."""

    apps: tuple[str, ...]
    window: ReportWindow
    tiers: RoyaltyTiers = field(default_factory=RoyaltyTiers)
    markets: tuple[str, ...] = MARKETS
    paid_source_types: tuple[str, ...] = PAID_SOURCE_TYPES
    channel_alias: tuple[tuple[str, str], ...] = CHANNEL_ALIAS
    excluded_channel_pattern: str = EXCLUDED_CHANNEL_PATTERN
    campaign_type: str = CAMPAIGN_TYPE
    google_reduced_fee_from: dt.date = GOOGLE_REDUCED_FEE_FROM
    #: reproduce the published job's tier-c day-14/day-28 IAP, which reads day-1 revenue
    legacy_day1_override: bool = True
    #: apply the channel alias on the install side too (the published job does not)
    alias_install_channels: bool = False
    #: predicates of the fact side on the install side too (the published job has neither): channels not
    #: like this pattern, and this campaign type of installs that have the column
    install_excluded_channel_pattern: str | None = None
    install_campaign_type: str | None = None
    #: a SKAN campaign matching several MMP source types: "keep" one enriched row per match
    #: (the published job), "collapse" them to one row (spends added, source type of the largest
    #: spend), or "error" (fail the run, naming such campaigns)
    fanout: str = "keep"
    residual_total_types: tuple[str, ...] = RESIDUAL_TOTAL_TYPES
    residual_paid_type: str = RESIDUAL_PAID_TYPE

    def with_window(self, window: ReportWindow) -> JobConfig:
        return replace(self, window=window)

    def clean(self) -> JobConfig:
        """The corrected preset: no day-1 override, aliases on both sides."""
        return replace(self, legacy_day1_override=False, alias_install_channels=True)

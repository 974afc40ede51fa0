"""Revenue-share netting (gross -> publisher share) as generated Catalyst expressions.

A share card is data: (application, rate) pairs plus a default. It compiles into one
``CASE WHEN`` chain of Spark SQL text, parsed once on the JVM (``F.expr`` by the caller), so
netting is a plain built-in expression inside whole-stage codegen and costs no join or shuffle.
Tiered cards (subscription revenue) pick a card by market and effective date first.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from .. import config as C


def sql_str(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_date(value: dt.date) -> str:
    return f"DATE'{value.isoformat()}'"


def sql_col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _expr(measure: str) -> str:
    """A bare column name is quoted; anything else is taken as a SQL expression."""
    return sql_col(measure) if _IDENT.match(measure) else f"({measure})"


def _scaled(measure: str, rate: Decimal | None) -> str:
    return measure if rate is None else f"{measure} * {rate}"


@dataclass(frozen=True)
class ShareCard:
    """Publisher share per application; ``default`` for the others (None keeps the gross)."""

    by_app: tuple[tuple[str, Decimal | None], ...]
    default: Decimal | None

    @classmethod
    def from_table(cls, table: dict[str, str | None], tiers: C.RoyaltyTiers) -> ShareCard:
        default = table["default"]
        return cls(tiers.apps_for(table), None if default is None else Decimal(default))

    def sql(self, measure: str, app: str = C.APP, overrides: Mapping[str, str] | None = None) -> str:
        """``measure * share(app)`` as SQL; ``measure`` is a column name or an expression
        (such as ``sum(x)`` when the share is applied per group), ``overrides`` swaps the
        measure for named applications."""
        overrides = overrides or {}
        m, a = _expr(measure), sql_col(app)
        arms = " ".join(
            f"WHEN {a} = {sql_str(name)} THEN {_scaled(_expr(overrides.get(name, measure)), rate)}"
            for name, rate in self.by_app
        )
        fallback = _scaled(m, self.default)
        return f"CASE {arms} ELSE {fallback} END" if arms else fallback


@dataclass(frozen=True)
class TieredCard:
    """Ordered (SQL condition, card) arms; the first true condition picks the card, else 0.
    A NULL measure also counts as 0."""

    arms: tuple[tuple[str, ShareCard], ...]

    def sql(self, measure: str, app: str = C.APP) -> str:
        arms = " ".join(f"WHEN {cond} THEN {card.sql(measure, app)}" for cond, card in self.arms)
        return f"coalesce(CASE {arms} ELSE 0 END, 0)" if arms else "0"


class RateBook:
    """All share cards of one run, bound to the run's configuration."""

    def __init__(self, cfg: C.JobConfig):
        self.cfg = cfg
        self.iap = ShareCard.from_table(C.IAP_SHARE, cfg.tiers)
        self.ad = ShareCard.from_table(C.AD_SHARE, cfg.tiers)
        self.sub_full_fee = ShareCard.from_table(C.SUB_SHARE_FULL_FEE, cfg.tiers)
        self.sub_reduced_fee = ShareCard.from_table(C.SUB_SHARE_REDUCED_FEE, cfg.tiers)

    def _google_arms(self, market: str, date: str) -> list[tuple[str, ShareCard]]:
        go = f"{sql_col(market)} = {sql_str(C.GOOGLE_MARKET)}"
        cut = sql_date(self.cfg.google_reduced_fee_from)
        d = sql_col(date)
        return [
            (f"{go} AND {d} < {cut}", self.sub_full_fee),
            (f"{go} AND {d} >= {cut}", self.sub_reduced_fee),
        ]

    def subscription_revenue(self, market: str = C.MARKET, date: str = C.DATE) -> TieredCard:
        """Subscription revenue: Google by cut-over date, iOS by age relative to the run date."""
        it = f"{sql_col(market)} = {sql_str(C.IOS_MARKET)}"
        boundary = sql_date(self.cfg.window.ios_reduced_fee_before)
        d = sql_col(date)
        return TieredCard(
            tuple(
                self._google_arms(market, date)
                + [
                    (f"{it} AND {d} < {boundary}", self.sub_reduced_fee),
                    (f"{it} AND {d} >= {boundary}", self.sub_full_fee),
                ]
            )
        )

    def subscription_ltv(self, market: str = C.MARKET, date: str = C.DATE) -> TieredCard:
        """Projected subscription LTV: Google by cut-over date, iOS always at the full fee."""
        it = f"{sql_col(market)} = {sql_str(C.IOS_MARKET)}"
        return TieredCard(tuple(self._google_arms(market, date) + [(it, self.sub_full_fee)]))

    def tier_c_day1_overrides(self, day: int) -> dict[str, str]:
        """Legacy quirk: tier-c day-14 and day-28 IAP revenue read day-1 revenue."""
        tier_c = self.cfg.tiers.tier_c
        if self.cfg.legacy_day1_override and tier_c is not None and day in (14, 28):
            return {tier_c: "REVS_DAY_001_AMT"}
        return {}

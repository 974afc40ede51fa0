"""Share cards as data: an effective-dated table instead of configuration.

A row says which share of a kind of revenue the publisher keeps for one application in one
market from ``FROM_DT`` (included) to ``TO_DT`` (excluded). A new licence, rate or effective
date is a row, not a code change. Kinds: ``IAP`` (revenue and LTV, SKAN's too), ``AD``, ``SUB`` (revenue)
and ``SUB_LTV``.

``checked_cards`` refuses a table that gives a day two shares or, for the run's applications, markets and days,
none; ``CardBook`` is then what one run nets its roll-ups with.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from .rates import RateBook, ShareCard, sql_col, sql_date, sql_str

SCHEMA = f"KIND string, {C.APP} string, {C.MARKET} string, FROM_DT date, TO_DT date, SHARE decimal(4,3)"
KINDS = ("IAP", "AD", "SUB", "SUB_LTV")
EVER, NEVER = dt.date(1, 1, 1), dt.date(9999, 12, 31)
#: cards are broadcast up to this many rows (some 100 bytes each); beyond, the join shuffles them
BROADCAST_ROWS = 10_000
#: so is the calendar of a run's shares, a row for each application, market and day
BROADCAST_DAYS = 200_000
#: faulty cards written out in the message
SHOWN = 20


class CardError(Exception):
    """Raised for a card table that does not give every day one share; ``total`` counts all faults."""

    def __init__(self, total: int, shown: list[Row]):
        self.total, self.shown = total, shown
        lines = [f"  {r.FAULT}: {r.KIND} / {r[C.APP]} / {r[C.MARKET]}, {r.FROM_DT} to {r.TO_DT}" for r in shown]
        super().__init__("\n".join([f"{total} fault(s) in the share cards:", *lines]))


def conformed_cards(cards: DataFrame) -> DataFrame:
    """The card columns under the job's spelling and types; others are left out, a missing one is an error."""
    spelled = {c.upper(): c for c in cards.columns}
    wanted = SCHEMA.split(", ")
    missing = [w.split()[0] for w in wanted if w.split()[0] not in spelled]
    if missing:
        raise ValueError(f"share cards: missing {', '.join(missing)}")
    return cards.selectExpr(*[f"CAST({sql_col(spelled[n])} AS {kind}) AS {n}" for n, kind in (w.split() for w in wanted)])


def _reached(spans: DataFrame) -> DataFrame:
    """``spans`` with the furthest end of those of their key that begin before them."""
    before = Window.partitionBy("KIND", C.APP, C.MARKET).orderBy("FROM_DT", "TO_DT").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("REACHED", F.max("TO_DT").over(before))


def _overlaps(cards: DataFrame) -> DataFrame:
    return _reached(cards).where("REACHED > FROM_DT").select(
        F.lit("overlap").alias("FAULT"), "KIND", C.APP, C.MARKET, "FROM_DT", F.least("REACHED", "TO_DT").alias("TO_DT")
    )


def card_faults(cards: DataFrame, cfg: C.JobConfig, kinds: Sequence[str] = KINDS) -> DataFrame:
    """Every fault of a card table, a row each: FAULT, KIND, application, market and the days at fault.

    ``void``: a NULL or a span without a day. ``negative``: a share below 0. ``overlap``: days that two rows cover, whatever the
    application and kind. ``gap``: days of the run's window that no row covers, for its kinds, applications and
    markets. Neighbouring rows of a key are compared by one window over them: the furthest end so far tells both
    (a key has as many rows as it had rates).
    """
    key = ("KIND", C.APP, C.MARKET)
    day = lambda d: F.expr(sql_date(d))
    start, end = cfg.window.start, max(cfg.window.end + dt.timedelta(days=1), cfg.window.skan_end_exclusive)
    nulls = " OR ".join(f"{c} IS NULL" for c in (*key, "FROM_DT", "TO_DT", "SHARE"))
    void = f"{nulls} OR FROM_DT >= TO_DT"
    columns = [*key, "FROM_DT", "TO_DT"]
    good = cards.where(f"NOT ({void})")
    # the run's keys, as a span that ends where its window begins and one that begins where it ends
    asked = cards.sparkSession.createDataFrame(
        [(k, a, m) for k in kinds for a in cfg.apps for m in cfg.markets], ", ".join(f"{k} string" for k in key)
    )
    edges = asked.select(*key, day(EVER).alias("FROM_DT"), day(start).alias("TO_DT")).union(asked.select(*key, day(end), day(NEVER)))
    covered = _reached(good.join(F.broadcast(asked), list(key), "left_semi").select(*columns).union(edges))
    gaps = covered.where("REACHED < FROM_DT").select(
        F.lit("gap").alias("FAULT"), *key, F.greatest("REACHED", day(start)).alias("A"), F.least("FROM_DT", day(end)).alias("Z")
    ).where("A < Z")
    return (
        cards.where(void).select(F.lit("void").alias("FAULT"), *columns)
        .union(good.where("SHARE < 0").select(F.lit("negative"), *columns))
        .union(_overlaps(good))
        .union(gaps)
    )


def checked_cards(cards: DataFrame, cfg: C.JobConfig, kinds: Sequence[str] = KINDS) -> DataFrame:
    """``cards`` conformed, or CardError."""
    cards = conformed_cards(cards)
    faults = card_faults(cards, cfg, kinds)
    shown = faults.orderBy("FAULT", "KIND", C.APP, C.MARKET, "FROM_DT").limit(SHOWN).collect()
    if shown:
        raise CardError(faults.count(), shown)
    return cards


def configured_cards(spark: SparkSession, cfg: C.JobConfig) -> DataFrame:
    """All the configured shares of a run, as a card table."""
    book = RateBook(cfg)
    cut, aged = cfg.google_reduced_fee_from, cfg.window.ios_reduced_fee_before
    spans: list[tuple[str, str, dt.date, dt.date, ShareCard]] = []
    for market in cfg.markets:
        spans += [("IAP", market, EVER, NEVER, book.iap), ("AD", market, EVER, NEVER, book.ad)]
    for kind in ("SUB", "SUB_LTV"):
        if C.GOOGLE_MARKET in cfg.markets:
            spans += [(kind, C.GOOGLE_MARKET, EVER, cut, book.sub_full_fee), (kind, C.GOOGLE_MARKET, cut, NEVER, book.sub_reduced_fee)]
    if C.IOS_MARKET in cfg.markets:
        spans += [("SUB", C.IOS_MARKET, EVER, aged, book.sub_reduced_fee), ("SUB", C.IOS_MARKET, aged, NEVER, book.sub_full_fee)]
        spans += [("SUB_LTV", C.IOS_MARKET, EVER, NEVER, book.sub_full_fee)]
    rows = []
    for kind, market, start, end, card in spans:
        for app in cfg.apps:
            share = dict(card.by_app).get(app, card.default)
            rows.append((kind, app, market, start, end, 1 if share is None else share))  # None keeps the gross value
    # other markets have no subscription share
    for kind in ("SUB", "SUB_LTV"):
        rows += [(kind, a, m, EVER, NEVER, 0) for a in cfg.apps for m in cfg.markets if m not in (C.GOOGLE_MARKET, C.IOS_MARKET)]
    return spark.createDataFrame([(*r[:5], Decimal(str(r[5]))) for r in rows], SCHEMA)


class CardBook:
    """The shares of one run from a checked card table, by day.

    The spans are laid out once as a *calendar*: a row for each application, market and day of the run with its
    share of every kind. A roll-up meets it by plain equality on application, market and day (its grouping keys, so after
    it has aggregated), in one join for all kinds instead of a range join for each.
    """

    def __init__(self, cards: DataFrame, cfg: C.JobConfig, kinds: Sequence[str] = KINDS):
        self.cfg = cfg
        cards = checked_cards(cards, cfg, kinds)
        last = max(cfg.window.end, cfg.window.skan_end_exclusive - dt.timedelta(days=1))
        days = f"sequence(greatest(FROM_DT, {sql_date(cfg.window.start)}), least(date_sub(TO_DT, 1), {sql_date(last)}))"
        own = cards.where(F.col(C.APP).isin(list(cfg.apps)) & F.col(C.MARKET).isin(list(cfg.markets)))
        dated = own.where(f"FROM_DT <= {sql_date(last)} AND TO_DT > {sql_date(cfg.window.start)}").selectExpr(
            "KIND", C.APP, C.MARKET, f"explode({days}) AS {C.DATE}", "SHARE"
        )
        shares = [F.expr(f"max(CASE WHEN KIND = {sql_str(k)} THEN SHARE END) AS {self.share(k)}") for k in kinds]
        self.calendar = dated.groupBy(*C.K3).agg(*shares)
        n_days = (last - cfg.window.start).days + 1
        self.small = len(cfg.apps) * len(cfg.markets) * n_days <= BROADCAST_DAYS

    @staticmethod
    def share(kind: str) -> str:
        return f"{kind}_SHARE"

    def joined(self, rollup: DataFrame) -> DataFrame:
        """``rollup`` (with the columns of K3) with the shares of its application, market and day; NULL beyond the run's."""
        return rollup.join(F.broadcast(self.calendar) if self.small else self.calendar, list(C.K3), "left")


def subscription_cards(spark: SparkSession, cfg: C.JobConfig) -> DataFrame:
    """The configured subscription-revenue shares of a run, as a card table."""
    book = RateBook(cfg)
    spans = [
        (C.GOOGLE_MARKET, EVER, cfg.google_reduced_fee_from, book.sub_full_fee),
        (C.GOOGLE_MARKET, cfg.google_reduced_fee_from, NEVER, book.sub_reduced_fee),
        (C.IOS_MARKET, EVER, cfg.window.ios_reduced_fee_before, book.sub_reduced_fee),
        (C.IOS_MARKET, cfg.window.ios_reduced_fee_before, NEVER, book.sub_full_fee),
    ]
    rows = [
        ("SUB", app, market, start, end, dict(card.by_app).get(app, card.default))
        for market, start, end, card in spans
        for app in cfg.apps
    ]
    return spark.createDataFrame(rows, SCHEMA)


def net_by_card(sums: DataFrame, cards: DataFrame, kind: str, measures: dict[str, str]) -> DataFrame:
    """``sums`` (per application, market and day) with each measure (gross column -> net name)
    times the share its card row gives; 0 where no card covers the day or the measure is NULL.

    Rates apply after aggregation, so the join meets one row per application, market and day. Cards that
    give a day two shares raise CardError: they would double every sum.
    """
    own = cards.where(F.col("KIND") == kind)
    twice = _overlaps(own)
    if shown := twice.limit(SHOWN).collect():
        raise CardError(twice.count(), shown)
    own = own.drop("KIND")
    if own.count() <= BROADCAST_ROWS:
        own = F.broadcast(own)
    joined = sums.alias("s").join(
        own.alias("c"),
        (F.col(f"s.{C.APP}") == F.col(f"c.{C.APP}"))
        & (F.col(f"s.{C.MARKET}") == F.col(f"c.{C.MARKET}"))
        & (F.col(f"s.{C.DATE}") >= F.col("c.FROM_DT"))
        & (F.col(f"s.{C.DATE}") < F.col("c.TO_DT")),
        "left",
    )
    return joined.selectExpr(
        *[f"s.{sql_col(k)}" for k in C.K3],
        *[f"coalesce(s.{sql_col(gross)} * c.SHARE, 0) AS {sql_col(net)}" for gross, net in measures.items()],
    )

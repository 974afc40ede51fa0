"""Share cards as one checked relation for every roll-up."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from conftest import SMOKE_DIR, D
from pyspark.sql import functions as F
from rows import fact_df, fact_row

from spendlens import config as C
from spendlens.functions import cards as K
from spendlens.operators.rollup import campaign_rollup, install_ltv_rollup, skan_rollup
from spendlens.plans.pipeline import build
from spendlens.session import Scratch
from spendlens.sources import fixtures

DAY = dt.date(2022, 5, 1)


@pytest.fixture
def small(cfg):
    """One application, one market, the days from 2022-05-01 to 2022-05-10 (SKAN: to 2022-05-12)."""
    window = C.ReportWindow(start=DAY, as_of=dt.date(2022, 5, 13))
    return replace(cfg, apps=("A",), markets=("IT",), window=window)


def table(spark, *spans, kind="IAP", app="A", market="IT"):
    rows = [(kind, app, market, a, z, None if s is None else D(s)) for a, z, s in spans]
    return spark.createDataFrame(rows, K.SCHEMA)


def faults(cards, cfg):
    found = K.card_faults(K.conformed_cards(cards), cfg, ["IAP"]).collect()
    return sorted(map(tuple, found), key=lambda f: tuple(map(str, f)))


def d(n):
    return dt.date(2022, 5, n)


def test_a_day_with_two_shares_is_refused(spark, small):
    overlap = table(spark, (K.EVER, d(5), "0.5"), (d(4), K.NEVER, "0.6"))
    assert faults(overlap, small) == [("overlap", "IAP", "A", "IT", d(4), d(5))]
    twice = table(spark, (K.EVER, K.NEVER, "0.5"), (K.EVER, K.NEVER, "0.5"))
    assert [f[0] for f in faults(twice, small)] == ["overlap"]
    inside = table(spark, (K.EVER, K.NEVER, "0.5"), (d(2), d(3), "0.6"), (d(7), d(9), "0.6"))
    assert [(f[0], *f[4:]) for f in faults(inside, small)] == [("overlap", d(2), d(3)), ("overlap", d(7), d(9))]
    with pytest.raises(K.CardError, match="overlap: IAP / A / IT, 2022-05-04 to 2022-05-05"):
        K.CardBook(overlap, small, ["IAP"])
    sums = fact_df(spark, [fact_row(app="A", date=d(4), REVS_DAY_001_AMT=D(10))])
    with pytest.raises(K.CardError):
        K.net_by_card(sums, overlap, "IAP", {"REVS_DAY_001_AMT": "NET"})


def test_days_of_the_run_without_a_share_are_refused(spark, small):
    assert faults(table(spark, (d(1), d(13), "0.5")), small) == []  # exactly the run's days
    assert faults(table(spark, (d(1), d(6), "0.5"), (d(6), d(13), "0.4")), small) == []
    gaps = faults(table(spark, (d(2), d(6), "0.5"), (d(8), d(12), "0.4")), small)
    assert [(f[0], *f[4:]) for f in gaps] == [("gap", d(1), d(2)), ("gap", d(6), d(8)), ("gap", d(12), d(13))]
    assert [(f[0], *f[4:]) for f in faults(table(spark, (K.EVER, K.NEVER, "1"), app="B"), small)] == [("gap", d(1), d(13))]
    far = faults(table(spark, (dt.date(2020, 1, 1), dt.date(2020, 2, 1), "0.5"), (dt.date(2020, 3, 1), K.NEVER, "0.4")), small)
    assert far == []  # a gap before the run's days matters to no row
    with pytest.raises(K.CardError) as e:
        K.CardBook(table(spark), small, K.KINDS)
    assert e.value.total == len(K.KINDS) and all(r.FAULT == "gap" for r in e.value.shown)


def test_void_rows_and_spellings(spark, small):
    bad = table(spark, (K.EVER, K.NEVER, "0.5"), (d(5), d(5), "0.5"), (None, d(5), "0.5"), (d(1), d(2), None))
    assert [f[0] for f in faults(bad, small)] == ["void"] * 3
    assert [f[0] for f in faults(table(spark, (K.EVER, K.NEVER, "-0.5")), small)] == ["negative"]
    lower = table(spark, (K.EVER, K.NEVER, "0.5")).toDF("kind", "application_family_name", "market_cd", "from_dt", "to_dt", "share")
    assert faults(lower.withColumn("note", F.lit("x")), small) == []
    with pytest.raises(ValueError, match="SHARE"):
        K.conformed_cards(lower.drop("share"))


def test_every_rollup_is_the_same_by_cards(spark):
    cfg, src = fixtures.fixture_config(), fixtures.load(spark, SMOKE_DIR)
    book = K.CardBook(K.configured_cards(spark, cfg), cfg)
    for by_config, by_cards in (
        (campaign_rollup(src.fact, cfg), campaign_rollup(src.fact, cfg, book)),
        (install_ltv_rollup(src.installs, src.projections, cfg), install_ltv_rollup(src.installs, src.projections, cfg, book)),
        (skan_rollup(src.skan, cfg), skan_rollup(src.skan, cfg, book)),
    ):
        assert by_config.dtypes == by_cards.dtypes
        assert sorted(map(str, by_config.collect())) == sorted(map(str, by_cards.collect()))


def test_a_rate_change_is_a_row(spark, cfg):
    """Half the share from a day on, for one application and kind: nothing else changes."""
    change = dt.date(2022, 6, 1)
    cards = K.configured_cards(spark, cfg)
    own = (F.col("KIND") == "IAP") & (F.col(C.APP) == "APP_A") & (F.col(C.MARKET) == "IT")
    rows = cards.where(~own).union(cards.where(own).withColumn("TO_DT", F.lit(change))).union(
        cards.where(own).withColumns({"FROM_DT": F.lit(change), "SHARE": (F.col("SHARE") / 2).cast("decimal(4,3)")})
    )
    book = K.CardBook(rows, cfg)
    facts = [
        fact_row(app=app, market=m, date=day, USER_QTY=D(1), REVS_DAY_001_AMT=D(100), AD_REVS_DAY_001_AMT=D(100))
        for app in ("APP_A", "OTHER") for m in ("IT", "GO") for day in (change - dt.timedelta(days=1), change)
    ]
    got = {
        (r[C.APP], r[C.MARKET], r[C.DATE] < change): (r.IAP_REVS_DAY_001_AMT, r.AD_REVS_DAY_001_AMT)
        for r in campaign_rollup(fact_df(spark, facts), cfg, book).collect()
    }
    for app, iap, ad in (("APP_A", "61.6", "88"), ("OTHER", "70", "100")):
        for market in ("IT", "GO"):
            assert got[app, market, True] == (D(iap), D(ad))
            assert got[app, market, False] == (D("30.8") if (app, market) == ("APP_A", "IT") else D(iap), D(ad))


def test_null_sums_stay_null_but_subscriptions(spark, cfg):
    book = K.CardBook(K.configured_cards(spark, cfg), cfg)
    (r,) = campaign_rollup(fact_df(spark, [fact_row(app="APP_A", USER_QTY=D(1))]), cfg, book).collect()
    assert r.IAP_REVS_DAY_001_AMT is None and r.AD_LTV is None and r.SUB_REVS_DAY_001_AMT == 0


def test_the_whole_job_by_cards(spark):
    cfg, src = fixtures.fixture_config(), fixtures.load(spark, SMOKE_DIR)
    plain = build(src, cfg, Scratch(spark)).channel
    by_cards = build(src, cfg, Scratch(spark), cards=K.configured_cards(spark, cfg)).channel
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_cards.collect()))


def test_many_cards_are_joined_by_day_without_a_broadcast(spark, cfg, monkeypatch):
    cards = K.configured_cards(spark, cfg)
    plan = lambda book: book.joined(spark.createDataFrame([("APP_A", "IT", DAY)], f"{C.APP} string, {C.MARKET} string, {C.DATE} date"))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(K.CardBook(cards, cfg))
    monkeypatch.setattr(K, "BROADCAST_DAYS", 100)
    assert "strategy=broadcast" not in plan(K.CardBook(cards, cfg))

"""X6, X8 and X9: merge, precedence, residual NULL rules, clamp and invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import D
from rows import campaign_schema

from spendlens import config as C
from spendlens.functions.metrics import clamp_nonnegative
from spendlens.operators.merge import merge_details
from spendlens.operators.precedence import (
    SKAN_METRICS,
    FanOutError,
    assert_no_fanout,
    enriched_rows,
    fanout_rows,
    precedence_join,
    remainder_rows,
)
from spendlens.operators.reconcile import assemble_campaign, organic_residual

DAY = dt.date(2022, 5, 1)
FACT_METRICS = [m for m in C.METRICS_RAW if m not in ("SUB_LTV", "TOTAL_LTV")]


def detail(src, channel, promo, spend, installs, market="IT", app="APP_A", date=DAY, fill=D(1)):
    vals = {m: fill for m in C.METRICS_RAW}
    vals.update(SPEND=spend, INSTALL_NUM=installs)
    return (app, market, src, channel, promo, date, *[vals[m] for m in C.METRICS_RAW])


def skan(channel, promo, installs, app="APP_A", date=DAY):
    vals = {m: D(0) for m in C.METRICS_RAW}
    vals.update(INSTALL_NUM=installs, IAP_LTV=D(5), TOTAL_LTV=D(7))
    return (app, "IT", "SKAN", channel, promo, date, *[vals[m] for m in C.METRICS_RAW if m != "SPEND"])


def test_merge_details_fill_and_total(spark):
    fact = spark.createDataFrame(
        [
            ("APP_A", "IT", "MK", "A", "P", DAY, *[D(1)] * len(FACT_METRICS)),
            ("APP_A", "IT", None, "ORGANIC", "ORGANIC", DAY, *[D(1)] * len(FACT_METRICS)),
            ("APP_A", "IT", "MC", "A", "P", DAY, *([D(1)] * (len(FACT_METRICS) - 1) + [None])),
        ],
        campaign_schema(metrics=FACT_METRICS),
    )
    sub = spark.createDataFrame(
        [
            ("APP_A", "IT", "MK", "A", "P", DAY, 3, D(10)),
            ("APP_A", "IT", None, "ORGANIC", "ORGANIC", DAY, 3, D(10)),  # NULL key never matches
        ],
        "APPLICATION_FAMILY_NAME string, MARKET_CD string, USER_SOURCE_TYPE_CD string, "
        "CHANNEL_NAME string, PROMOTION_NAME string, CALENDAR_DT date, INDIVIDUAL_INSTALLS long, "
        "SUB_LTV decimal(32,8)",
    )
    out = {r.USER_SOURCE_TYPE_CD: r for r in merge_details(fact, sub).collect()}
    assert out["MK"].SUB_LTV == 10 and out["MK"].TOTAL_LTV == 12
    assert out[None].SUB_LTV == 0 and out[None].TOTAL_LTV == 2
    assert out["MC"].TOTAL_LTV is None  # AD_LTV NULL -> TOTAL NULL
    assert "INDIVIDUAL_INSTALLS" not in out["MK"].asDict()


def _halves(details, sk):
    joined = precedence_join(details, sk)
    return enriched_rows(joined), remainder_rows(joined, details)


def _inputs(spark):
    details = spark.createDataFrame(
        [
            detail("MK", "A", "P1", D(100), D(10)),  # SKAN reports A/P1
            detail("MM", "A", "P1", D(50), D(5)),  # same K5, other type: fan-out
            detail("MK", "B", "P2", D(30), D(3)),  # not reported by SKAN: paid remainder
            detail("US", "ORGANIC", "ORGANIC", D(0), D(40)),
            detail("MC", "C", "P3", D(20), D(2)),
            detail(None, "ORGANIC", "ORGANIC", D(1), D(1)),  # iOS NULL type: dropped at the union
            detail("MK", "G", "P9", D(8), D(8), market="GO"),
            detail("US", "ORGANIC", "ORGANIC", D(1), D(1), date=DAY + dt.timedelta(days=1)),
        ],
        campaign_schema(),
    )
    sk = spark.createDataFrame(
        [skan("A", "P1", D(20)), skan("Z", "P0", D(6)), skan("Q", "P0", D(1), date=DAY + dt.timedelta(days=7))],
        campaign_schema(with_source=True, with_spend=False, with_source_type=False),
    )
    return details, sk


def test_precedence_fanout_defaults_and_anti_join(spark):
    details, sk = _inputs(spark)
    enriched, remainder = _halves(details, sk)
    got = sorted((r.CHANNEL_NAME, r.USER_SOURCE_TYPE_CD, r.SPEND) for r in enriched.collect())
    assert got == [("A", "MK", 100), ("A", "MM", 50), ("Q", "MK", 0), ("Z", "MK", 0)]
    rem = sorted((r.USER_SOURCE_TYPE_CD or "-", r.CHANNEL_NAME) for r in remainder.collect())
    assert ("MK", "A") not in rem and ("MM", "A") not in rem
    assert ("-", "ORGANIC") in rem  # NULL-key row survives the anti join
    assert {r.SOURCE for r in remainder.collect()} == {"Non-SKAN"}


def test_fanout_keys_lists_campaigns_matching_several_types(spark):
    details, sk = _inputs(spark)
    got = [(r.CHANNEL_NAME, r.PROMOTION_NAME, r.MATCHES) for r in fanout_rows(precedence_join(details, sk)).collect()]
    assert got == [("A", "P1", 2)]


def test_residual_rules(spark, cfg):
    details, sk = _inputs(spark)
    enriched, remainder = _halves(details, sk)
    res = {r.CALENDAR_DT: r for r in organic_residual(details, enriched, remainder, cfg).collect()}
    # total (MK, US on iOS) = 10 + 40 + 3 = 53; paid = 3 (B only); SKAN = 20 + 20 + 6 = 46
    assert res[DAY].INSTALL_NUM == D(53) - 3 - 46
    assert res[DAY].SPEND == D(130) - 30 - (100 + 50)
    assert (res[DAY].USER_SOURCE_TYPE_CD, res[DAY].CHANNEL_NAME, res[DAY].SOURCE) == ("US", "ORGANIC", "Non-SKAN")
    # a day with only a total row: nothing subtracted
    assert res[DAY + dt.timedelta(days=1)].INSTALL_NUM == 1
    # a SKAN-only day yields no residual row
    assert DAY + dt.timedelta(days=7) not in res


def test_residual_total_null_stays_null(spark, cfg):
    details = spark.createDataFrame([detail("US", "ORGANIC", "ORGANIC", None, D(4))], campaign_schema())
    sk = spark.createDataFrame([skan("A", "P1", D(1))], campaign_schema(with_source=True, with_spend=False, with_source_type=False))
    enriched, remainder = _halves(details, sk)
    r = organic_residual(details, enriched, remainder, cfg).collect()[0]
    assert r.SPEND is None and r.INSTALL_NUM == 3


def test_assemble_union_and_clamp(spark, cfg):
    details, sk = _inputs(spark)
    enriched, remainder = _halves(details, sk)
    rows = assemble_campaign(details, enriched, remainder, cfg).collect()
    assert all(r[m] is not None and r[m] >= 0 for r in rows for m in C.METRICS)
    kinds = sorted((r.MARKET_CD, r.SOURCE, r.USER_SOURCE_TYPE_CD, r.CHANNEL_NAME) for r in rows)
    assert ("IT", "Non-SKAN", "US", "ORGANIC") in kinds  # residual
    assert ("IT", "Non-SKAN", "MK", "B") in kinds and ("IT", "Non-SKAN", "MC", "C") in kinds
    assert ("GO", "Non-SKAN", "MK", "G") in kinds
    assert not any(k[2] is None for k in kinds)  # iOS NULL type dropped
    organic = [r for r in rows if r.USER_SOURCE_TYPE_CD == "US" and r.CALENDAR_DT == DAY]
    assert organic[0].INSTALL == 4 and organic[0].SPEND == 0  # spend clamped from -50


def test_clamp_nan_null_negative(spark):
    df = spark.createDataFrame(
        [(1.0,), (-2.0,), (None,), (float("nan"),)], "SPEND double"
    )
    got = [r.SPEND for r in clamp_nonnegative(df, ["SPEND"]).collect()]
    assert got[:3] == [1.0, 0.0, 0.0] and got[3] != got[3]
    again = [r.SPEND for r in clamp_nonnegative(clamp_nonnegative(df, ["SPEND"]), ["SPEND"]).collect()]
    assert again[:3] == got[:3]


def test_residual_matches_join_form_on_random_rows(spark, cfg):
    """Random details/SKAN rows with NULL metrics and fan-out: the one-shuffle residual
    equals the join form (total per K3, minus coalesced paid and SKAN sums)."""
    import random

    rnd = random.Random(11)
    days = [DAY + dt.timedelta(days=i) for i in range(4)]

    def val():
        return None if rnd.random() < 0.15 else D(rnd.randint(-50, 500))

    def m_row():
        return {m: val() for m in C.METRICS_RAW}

    details_rows, seen = [], set()
    for _ in range(150):
        key = (rnd.choice(["APP_A", "OTHER"]), rnd.choice(["IT", "GO"]), rnd.choice(["MK", "US", "MM", None]),
               rnd.choice(["A", "B", "C"]), rnd.choice(["P1", "P2"]), rnd.choice(days))
        if key in seen:
            continue
        seen.add(key)
        vals = m_row()
        details_rows.append((*key, *[vals[m] for m in C.METRICS_RAW]))
    skan_rows, sseen = [], set()
    for _ in range(40):
        key = (rnd.choice(["APP_A", "OTHER"]), "IT", "SKAN", rnd.choice(["A", "B", "Z"]), rnd.choice(["P1", "P2"]),
               rnd.choice(days))
        k5 = (key[0], key[3], key[4], key[5])
        if k5 in sseen:
            continue
        sseen.add(k5)
        vals = {m: val() if m in SKAN_METRICS else D(0) for m in C.METRICS_RAW}  # SKAN measures three
        skan_rows.append((*key, *[vals[m] for m in C.METRICS_RAW if m != "SPEND"]))
    details = spark.createDataFrame(details_rows, campaign_schema())
    sk = spark.createDataFrame(skan_rows, campaign_schema(with_source=True, with_spend=False, with_source_type=False))
    enriched, remainder = _halves(details, sk)
    got = {tuple(r[k] for k in C.K3): r.asDict() for r in organic_residual(details, enriched, remainder, cfg).collect()}

    # brute force, following the original statement
    names = ["APP", "MARKET", "TYPE", "CHANNEL", "PROMO", "DATE"]
    drows = [dict(zip(names, r[:6]), **dict(zip(C.METRICS_RAW, r[6:]))) for r in details_rows]
    skan_keys = {(r[0], r[1], r[3], r[4], r[5]) for r in skan_rows}
    enr = []
    for s in skan_rows:
        sv = dict(zip([m for m in C.METRICS_RAW if m != "SPEND"], s[6:]))
        matches = [d for d in drows if (d["APP"], d["MARKET"], d["CHANNEL"], d["PROMO"], d["DATE"]) == (s[0], s[1], s[3], s[4], s[5])]
        for d in matches or [None]:
            enr.append(((s[0], s[1], s[5]), dict(sv, SPEND=(d["SPEND"] if d and d["SPEND"] is not None else D(0)))))
    rem = [d for d in drows if (d["APP"], d["MARKET"], d["CHANNEL"], d["PROMO"], d["DATE"]) not in skan_keys]

    def sums(rows):
        out = {}
        for key, vals in rows:
            acc = out.setdefault(key, {})
            for m in C.METRICS_RAW:
                if vals[m] is not None:
                    acc[m] = acc.get(m, 0) + vals[m]
        return out

    k3 = lambda d: (d["APP"], d["MARKET"], d["DATE"])
    total = sums([(k3(d), d) for d in drows if d["MARKET"] == "IT" and d["TYPE"] in ("MK", "US")])
    paid = sums([(k3(d), d) for d in rem if d["MARKET"] == "IT" and d["TYPE"] == "MK"])
    skan_sum = sums(enr)
    want = {}
    for key, t in total.items():
        want[key] = {
            m: (t[m] - paid.get(key, {}).get(m, 0) - skan_sum.get(key, {}).get(m, 0)) if m in t else None
            for m in C.METRICS_RAW
        }
    assert set(got) == set(want)
    for key in want:
        for m in C.METRICS_RAW:
            assert got[key][m] == want[key][m], (key, m)


def test_collapse_adds_spends_and_keeps_one_row(spark):
    details, sk = _inputs(spark)
    rows = enriched_rows(precedence_join(details, sk), collapse=True).collect()
    got = sorted((r.CHANNEL_NAME, r.USER_SOURCE_TYPE_CD, r.SPEND, r.INSTALL_NUM) for r in rows)
    assert got == [("A", "MK", 150, 20), ("Q", "MK", 0, 1), ("Z", "MK", 0, 6)]


def test_every_fanout_is_counted_and_kept(spark):
    details = [detail(t, "A", f"P{i}", D(1), D(1)) for i in range(50) for t in ("MK", "MM")]
    joined = precedence_join(
        spark.createDataFrame(details, campaign_schema()),
        spark.createDataFrame(
            [skan("A", f"P{i}", D(2)) for i in range(60)],
            campaign_schema(with_source=True, with_spend=False, with_source_type=False),
        ),
    )
    with pytest.raises(FanOutError) as e:
        assert_no_fanout(joined)
    assert e.value.total == 50 and "50 SKAN campaign(s)" in str(e.value) and "First 20 of 50" in str(e.value)
    assert spark.read.parquet(e.value.path).count() == 50


def test_only_ios_rows_and_three_skan_metrics_meet_in_the_join(spark):
    details, sk = _inputs(spark)
    joined = precedence_join(details, sk)
    assert joined.where("MARKET_CD = 'GO'").count() == 0 and len(joined.columns) <= 35

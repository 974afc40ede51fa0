"""X1 / X5 / X7 / X10 / X11 rules on hand-written rows."""

from __future__ import annotations

import datetime as dt

from conftest import D
from pyspark.sql import types as T
from rows import fact_df, fact_row

from spendlens import config as C
from spendlens.operators.rollup import (
    campaign_rollup,
    install_ltv_rollup,
    skan_rollup,
)

IN = dt.date(2022, 5, 1)


def test_campaign_rollup_filters_fold_having(spark, cfg):
    end = cfg.window.end  # 2023-06-07
    rows = [
        fact_row(EXPENSE_AMT=D(10), USER_QTY=D(2)),
        fact_row(EXPENSE_AMT=D(5), USER_QTY=D(1)),  # same K6: summed
        fact_row(channel="SKANUAC", EXPENSE_AMT=D(3), USER_QTY=D(1)),  # renamed ADWORDS: same group
        fact_row(channel="X_UNTRUSTED", EXPENSE_AMT=D(100)),  # excluded on the raw name
        fact_row(channel=None, EXPENSE_AMT=D(100)),  # NOT LIKE drops NULL channels
        fact_row(ctype="Retargeting", EXPENSE_AMT=D(100)),
        fact_row(market="XX", EXPENSE_AMT=D(100)),
        fact_row(app="UNKNOWN", EXPENSE_AMT=D(100)),
        fact_row(date=end, promo="END", EXPENSE_AMT=D(1)),  # inclusive end
        fact_row(date=end + dt.timedelta(days=1), promo="LAG", EXPENSE_AMT=D(1)),  # lagged out
        fact_row(date=cfg.window.start, promo="START", EXPENSE_AMT=D(1)),
        fact_row(promo="NEG", EXPENSE_AMT=D(-1), USER_QTY=D(0)),  # HAVING drops
        fact_row(promo="NULLS"),  # all-NULL group dropped
        fact_row(promo="ONLYQTY", USER_QTY=D(3)),  # spend NULL, installs > 0: kept
        fact_row(source="US", promo="Z", EXPENSE_AMT=D(7)),  # unpaid: ORGANIC/ORGANIC
        fact_row(source=None, promo="Z", EXPENSE_AMT=D(7)),  # NULL type: ORGANIC, stays NULL
    ]
    out = {(r.USER_SOURCE_TYPE_CD, r.CHANNEL_NAME, r.PROMOTION_NAME, r.CALENDAR_DT): r
           for r in campaign_rollup(fact_df(spark, rows), cfg).collect()}
    assert out[("MK", "ADWORDS", "P1", IN)].SPEND == D(18)
    assert out[("MK", "ADWORDS", "P1", IN)].INSTALL_NUM == D(4)
    assert ("MK", "ADWORDS", "END", cfg.window.end) in out
    assert ("MK", "ADWORDS", "START", cfg.window.start) in out
    assert out[("MK", "ADWORDS", "ONLYQTY", IN)].SPEND is None
    assert out[("US", "ORGANIC", "ORGANIC", IN)].SPEND == D(7)
    assert out[(None, "ORGANIC", "ORGANIC", IN)].SPEND == D(7)
    assert len(out) == 6


def test_campaign_rollup_null_revenue_rules(spark, cfg):
    rows = [fact_row(EXPENSE_AMT=D(1), REVS_DAY_001_AMT=None, SUBSCRIPTIONS_REVS_DAY_001_AMT=None)]
    r = campaign_rollup(fact_df(spark, rows), cfg).collect()[0]
    assert r.IAP_REVS_DAY_001_AMT is None  # IAP/Ad sums keep NULL
    assert r.SUB_REVS_DAY_001_AMT == 0  # subscription sums are 0


INSTALL_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (C.APP, C.MARKET, C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION)]
    + [T.StructField("INSTALL_DT", T.DateType()), T.StructField("APPLICATION_CD", T.StringType()),
       T.StructField("ACCOUNT_ID", T.LongType()), T.StructField("USER_ID", T.LongType())]
)
PROJ_SCHEMA = T.StructType(
    [T.StructField("ACCOUNT_ID", T.LongType()), T.StructField("USER_ID", T.LongType()),
     T.StructField("APPLICATION_CD", T.StringType()), T.StructField("PROJECTION_DT", T.DateType())]
    + [T.StructField(c, T.DecimalType(18, 4)) for c in
       ("IAP_PROJECTEDREVENUE_365", "AD_PROJECTEDREVENUE_365", "SUB_PROJECTEDREVENUE_365")]
)


def test_install_ltv_ties_multiply_and_rates(spark, cfg):
    d1, d2 = dt.date(2022, 1, 1), dt.date(2022, 2, 1)
    installs = spark.createDataFrame(
        [
            ("OTHER", "IT", "MK", "SKANUAC", "P1", IN, "A", 1, 1),  # alias NOT applied
            ("OTHER", "IT", "MK", "SKANUAC", "P1", IN, "A", 2, 1),
            ("OTHER", "GO", "US", "X", "P1", IN, "A", 3, 1),  # unpaid fold
            ("OTHER", "IT", "MK", "U", "P1", IN, "A", 9, 9),  # no projection: dropped
        ],
        INSTALL_SCHEMA,
    )
    proj = spark.createDataFrame(
        [
            (1, 1, "A", d1, None, None, D(999)),
            (1, 1, "A", d2, None, None, D(10)),
            (1, 1, "A", d2, None, None, D(20)),  # tie: counted twice
            (2, 1, "A", d2, None, None, None),  # NULL sub contributes 0
            (3, 1, "A", d2, None, None, D(100)),
        ],
        PROJ_SCHEMA,
    )
    out = {(r.MARKET_CD, r.CHANNEL_NAME): r for r in install_ltv_rollup(installs, proj, cfg).collect()}
    it = out[("IT", "SKANUAC")]
    assert it.INDIVIDUAL_INSTALLS == 3
    assert it.SUB_LTV == D(30) * D("0.7")
    go = out[("GO", "ORGANIC")]
    assert go.SUB_LTV == D(100) * D("0.85")  # Google after the cut-over
    assert len(out) == 2


SKAN_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (C.APP, C.CHANNEL, "PROMOTION_CD")]
    + [T.StructField("INSTALL_DT", T.DateType())]
    + [T.StructField(c, T.DecimalType(18, 2)) for c in
       ("INSTALL_NUM", "GROSS_IAP_LTV_365_LATEST_VAL", "NET_OVERALL_LTV_365_LATEST_VAL")]
)


def test_skan_rollup_window_and_schema(spark, cfg):
    w = cfg.window
    rows = [
        ("APP_A", "ADWORDS", "P1", w.as_of - dt.timedelta(days=1), D(2), D(100), D(50)),  # not lagged
        ("APP_A", "ADWORDS", "P1", w.as_of, D(2), D(100), D(50)),  # run date excluded
        ("APP_A", "X_UNTRUSTED", "P1", IN, D(2), D(100), D(50)),
        ("NOPE", "ADWORDS", "P1", IN, D(2), D(100), D(50)),
        ("APP_A", "ADWORDS", "P1", w.start - dt.timedelta(days=1), D(2), D(100), D(50)),
    ]
    out = skan_rollup(spark.createDataFrame(rows, SKAN_SCHEMA), cfg).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.MARKET_CD, r.SOURCE, r.PROMOTION_NAME) == ("IT", "SKAN", "P1")
    assert r.IAP_LTV == D(100) * D("0.616") and r.TOTAL_LTV == D(50) and r.AD_LTV == 0
    assert r.SUB_REVS_DAY_028_AMT == 0 and "SPEND" not in r.asDict()


def test_install_ltv_hot_key_matches_brute_force(spark, cfg):
    """One user key holds most installs (a sentinel account): the pre-aggregated join must
    equal joining every install row to every tied latest projection row."""
    import random

    rnd = random.Random(7)
    d1, d2 = dt.date(2022, 1, 1), dt.date(2022, 3, 1)
    inst, proj = [], []
    for i in range(600):
        key = 0 if i % 3 else i  # two thirds on account 0
        src = rnd.choice(["MK", "MM", "US", None])
        inst.append(("APP_A", rnd.choice(["IT", "GO"]), src, rnd.choice(["A", "SKANFB"]), "P1",
                     rnd.choice([d1, d2]), "X", key, 1))
    for key in {r[7] for r in inst}:
        proj.append((key, 1, "X", d1, None, None, D(rnd.randint(1, 999)) / 100))
        proj.append((key, 1, "X", d2, None, None, D(rnd.randint(1, 999)) / 100))
        if key == 0:
            proj.append((key, 1, "X", d2, None, None, D("3.3333")))  # tie on the hot key
    installs = spark.createDataFrame(inst, INSTALL_SCHEMA)
    projections = spark.createDataFrame(proj, PROJ_SCHEMA)
    got = {(r.MARKET_CD, r.USER_SOURCE_TYPE_CD, r.CHANNEL_NAME, r.CALENDAR_DT): (r.INDIVIDUAL_INSTALLS, r.SUB_LTV)
           for r in install_ltv_rollup(installs, projections, cfg).collect()}
    latest = {}
    for k, u, a, d, *_, v in proj:
        latest.setdefault((k, u, a), []).append((d, v))
    full, reduced = {"APP_A": D("0.616")}, {"APP_A": D("0.748")}
    want = {}
    for app, m, st, ch, pr, d, acd, k, u in inst:
        rows = latest[(k, u, acd)]
        mx = max(x for x, _ in rows)
        paid = st in ("MM", "MK", "MC")
        key = (m, st, ch if paid else "ORGANIC", d)
        for x, v in rows:
            if x != mx:
                continue
            rate = full[app] if m == "IT" or d < cfg.google_reduced_fee_from else reduced[app]
            n, s = want.get(key, (0, D(0)))
            want[key] = (n + 1, s + v * rate)
    assert got == want

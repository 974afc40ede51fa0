"""Invariants of SURVEY section 5 on the smoke fixtures (real joins, fan-out, ties)."""

from __future__ import annotations

from collections import defaultdict

from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from spendlens import config as C
from spendlens.operators.merge import merge_details
from spendlens.operators.precedence import enriched_rows, precedence_join, remainder_rows
from spendlens.operators.reconcile import organic_residual, residual_parts
from spendlens.operators.rollup import campaign_rollup, install_ltv_rollup, skan_rollup
from spendlens.plans.pipeline import build
from spendlens.session import Scratch
from spendlens.sources import fixtures


def _stages(spark):
    cfg = fixtures.fixture_config()
    src = fixtures.load(spark, SMOKE_DIR)
    details = merge_details(
        campaign_rollup(src.fact, cfg), install_ltv_rollup(src.installs, src.projections, cfg)
    )
    skan = skan_rollup(src.skan, cfg)
    joined = precedence_join(details, skan)
    return cfg, details, skan, enriched_rows(joined), remainder_rows(joined, details)


def test_residual_plus_parts_equals_total(spark):
    cfg, details, skan, enriched, remainder = _stages(spark)
    total, paid, sk = residual_parts(details, enriched, remainder, cfg)
    res = {tuple(r[k] for k in C.K3): r for r in organic_residual(details, enriched, remainder, cfg).collect()}
    sums = defaultdict(lambda: defaultdict(lambda: 0))
    for name, df in (("T", total), ("P", paid), ("S", sk)):
        for r in df.collect():
            for m in ("SPEND", "INSTALL_NUM", "IAP_LTV", "TOTAL_LTV"):
                if r[m] is not None:
                    sums[(name,) + tuple(r[k] for k in C.K3)][m] += r[m]
    assert res, "fixtures must produce residual rows"
    for key, r in res.items():
        for m in ("SPEND", "INSTALL_NUM"):
            t = sums[("T",) + key][m]
            assert r[m] + sums[("P",) + key][m] + sums[("S",) + key][m] == t


def test_details_split_into_matched_and_unmatched(spark):
    _, details, skan, enriched, remainder = _stages(spark)
    keys = [F.col(k) for k in C.K5]
    matched = details.join(skan.select(*C.K5), on=list(C.K5), how="left_semi")
    assert matched.count() + remainder.count() == details.count()
    # every SKAN campaign survives, once per matching MMP row (at least once)
    assert enriched.select(*keys).distinct().count() == skan.select(*keys).distinct().count()
    assert enriched.count() >= skan.count()


def test_downstream_of_materialized_run_never_rescans_inputs(spark):
    cfg = fixtures.fixture_config()
    src = fixtures.load(spark, SMOKE_DIR)
    st = build(src, cfg, Scratch(spark))
    plan = spark._jvm.PythonSQLUtils.explainString(st.channel._jdf.queryExecution(), "formatted")
    scans = [line for line in plan.splitlines() if line.startswith("Location")]
    assert scans and all("/precedence" in line or "/details" in line for line in scans), scans

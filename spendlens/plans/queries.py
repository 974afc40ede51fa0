"""Registered queries: one per operator of the attribution job, over the fixture inputs.

Every query takes ``(spark, sf_dir)``, derives the fixture relations from the parquet
tables in ``sf_dir`` and returns a DataFrame; the pipeline queries (q14-q21) first write the
relation their branches share to the shared folder, as the daily run does, and return a
lazy plan over it. Decimal results are presented as
DOUBLE (exact decimal arithmetic inside, one conversion at the end) so that any engine
computing the same exact values produces identical numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.cards import CardBook, configured_cards, net_by_card, subscription_cards
from ..functions.fold import fold_organic
from ..functions.metrics import clamp_nonnegative
from ..functions.rates import RateBook, sql_col
from ..functions.window import mmp_window_class, skan_window_class
from ..operators.merge import merge_details
from ..operators.precedence import enriched_rows, precedence_join, remainder_rows
from ..operators.publication import job_publication
from ..operators.publish import REJECTED, PublishTarget, publish, rejected_rows, to_published
from ..operators.quality import (
    DATE_RULE,
    INSTALL_RULE,
    SPEND_RULE,
    GateRule,
    gate_by_rules,
    gate_outcome,
    regression_violations,
    rule_table,
    rules_from_table,
)
from ..operators.reconcile import (
    assemble_campaign,
    organic_residual,
    part_sums,
    residual_parts,
)
from ..operators.rollup import (
    campaign_rollup,
    column_types,
    game_rollup,
    group_sum,
    install_ltv_rollup,
    rated,
    scope_fact,
    skan_rollup,
)
from ..operators.snapshot import latest_per_key
from ..operators.verify import digests
from ..session import Scratch
from ..sources import fixtures
from ..sources.bucketed import bucketed_sources
from ..sources.catalog import Sources
from .pipeline import build

QueryFn = Callable[[SparkSession, str], DataFrame]

#: application whose previous installs are inflated in the failing gate case
GATE_FAIL_APP = "ECONOMY"
#: the passing gate case compares with a run one quarter earlier
GATE_PASS_SHIFT_DAYS = -91


def present(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE, everything else unchanged (one projection)."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, T.DecimalType) for f in fields):
        return df
    return df.selectExpr(
        *[
            f"CAST({sql_col(f.name)} AS DOUBLE) AS {sql_col(f.name)}"
            if isinstance(f.dataType, T.DecimalType)
            else sql_col(f.name)
            for f in fields
        ]
    )


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[Sources, C.JobConfig]:
    return fixtures.load(spark, sf_dir), fixtures.fixture_config()


def _details(src: Sources, cfg: C.JobConfig) -> DataFrame:
    return merge_details(
        campaign_rollup(src.fact, cfg),
        install_ltv_rollup(src.installs, src.projections, cfg),
    )


def _stages(spark: SparkSession, sf_dir: str, cfg: C.JobConfig | None = None, campaign_twice: bool = False):
    """The run's stages (see ``build``); their scratch relations last as long as the shared folder,
    since the caller reads the result later."""
    src, base_cfg = _inputs(spark, sf_dir)
    return build(src, cfg or base_cfg, Scratch(spark), write_campaign=campaign_twice)


def _precedence(src: Sources, cfg: C.JobConfig):
    details = _details(src, cfg)
    joined = precedence_join(details, skan_rollup(src.skan, cfg))
    return details, enriched_rows(joined), remainder_rows(joined, details)


# -- X1 / X3 -------------------------------------------------------------------------------


def q01_campaign_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    return present(campaign_rollup(src.fact, cfg))


def q02_net_iap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net IAP revenue and LTV per app and market; day 14/28 in both presets (legacy and
    clean differ only for the tier-c application)."""
    src, cfg = _inputs(spark, sf_dir)
    legacy, clean = RateBook(cfg), RateBook(cfg.clean())

    types = column_types(src.fact)

    def g(column: str) -> str:
        return group_sum(types, column)

    aggs = []
    for d in C.REVENUE_DAYS:
        day = f"{d:03d}"
        for book, suffix in ((legacy, ""), (clean, "_CLEAN")):
            if suffix and d not in (14, 28):
                continue
            overrides = {app: g(col) for app, col in book.tier_c_day1_overrides(d).items()}
            aggs.append(
                rated(book.iap.sql(g(f"REVS_DAY_{day}_AMT"), overrides=overrides), f"IAP_REVS_DAY_{day}_AMT{suffix}")
            )
    aggs.append(rated(legacy.iap.sql(g("LTV_365_LASTEST_VAL")), "IAP_LTV"))
    return present(scope_fact(src.fact, cfg).groupBy(C.APP, C.MARKET).agg(*aggs))


def q03_net_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    book = RateBook(cfg)
    types = column_types(src.fact)
    aggs = [
        rated(book.ad.sql(group_sum(types, f"AD_REVS_DAY_{d:03d}_AMT")), f"AD_REVS_DAY_{d:03d}_AMT")
        for d in C.REVENUE_DAYS
    ]
    aggs.append(rated(book.ad.sql(group_sum(types, "AD_LTV_365_LASTEST_VAL")), "AD_LTV"))
    return present(scope_fact(src.fact, cfg).groupBy(C.APP, C.MARKET).agg(*aggs))


def q04_net_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription revenue through the effective-dated card, per app, market and day."""
    src, cfg = _inputs(spark, sf_dir)
    card = RateBook(cfg).subscription_revenue()
    types = column_types(src.fact)
    aggs = [
        rated(
            card.sql(group_sum(types, f"SUBSCRIPTIONS_REVS_DAY_{d:03d}_AMT")),
            f"SUB_REVS_DAY_{d:03d}_AMT",
        )
        for d in C.REVENUE_DAYS
    ]
    return present(scope_fact(src.fact, cfg).groupBy(C.APP, C.MARKET, C.DATE).agg(*aggs))


# -- X4 / X5 -------------------------------------------------------------------------------


def q05_latest_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _ = _inputs(spark, sf_dir)
    return present(latest_per_key(src.projections, C.USER_KEY, "PROJECTION_DT"))


def q06_install_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    return present(install_ltv_rollup(src.installs, src.projections, cfg))


# -- X6 / X7 / X8 --------------------------------------------------------------------------


def q07_campaign_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    return present(_details(src, cfg))


def q08_skan_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    return present(skan_rollup(src.skan, cfg))


def q09_precedence_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    _, enriched, _ = _precedence(src, cfg)
    return present(enriched)


def q10_precedence_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cfg = _inputs(spark, sf_dir)
    # read by the join and by the rows of other markets: written once, as the daily run does
    details = Scratch(spark).write(_details(src, cfg), "details")
    joined = precedence_join(details, skan_rollup(src.skan, cfg))
    return present(remainder_rows(joined, details))


# -- X9 ------------------------------------------------------------------------------------


def _parts(spark: SparkSession, sf_dir: str):
    src, cfg = _inputs(spark, sf_dir)
    details, enriched, remainder = _precedence(src, cfg)
    return residual_parts(details, enriched, remainder, cfg)


def q11_ios_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, _, _ = _parts(spark, sf_dir)
    return present(part_sums(total, "IOS_ALL_"))


def q12_ios_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, paid, _ = _parts(spark, sf_dir)
    return present(part_sums(paid, "IOS_UNREPORTED_"))


def q13_skan_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, skan = _parts(spark, sf_dir)
    return present(part_sums(skan, "IOS_REPORTED_"))


def q14_residual_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = fixtures.fixture_config()
    st = _stages(spark, sf_dir, cfg)
    return present(organic_residual(st.details, st.enriched, st.remainder, cfg))


def q15_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete campaign table before the clamp, then clamped: only rows the clamp
    changed, with their clamped metrics."""
    cfg = fixtures.fixture_config()
    st = _stages(spark, sf_dir, cfg)
    raw = assemble_campaign(st.details, st.enriched, st.remainder, cfg, clamp=False)
    negative_or_null = None
    for m in C.METRICS:
        bad = F.col(m).isNull() | (F.col(m) < 0)
        negative_or_null = bad if negative_or_null is None else negative_or_null | bad
    return present(clamp_nonnegative(raw.where(negative_or_null), C.METRICS))


def q16_complete_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_stages(spark, sf_dir).campaign)


# -- X10 / X11 / X12 -----------------------------------------------------------------------


def q17_channel_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_stages(spark, sf_dir).channel)


def q18_game_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(game_rollup(_stages(spark, sf_dir).channel))


def _failing(current) -> DataFrame:
    """A previous publication like the current run's, one application's installs doubled."""
    doubled = F.when(F.col(C.APP) == GATE_FAIL_APP, F.col(C.INSTALL) * 2).otherwise(F.col(C.INSTALL))
    return to_published(current.campaign).withColumn(C.INSTALL, doubled)


def _gate_cases(cases: dict[str, DataFrame], judge) -> DataFrame:
    out = None
    for name, previous in cases.items():
        v = judge(previous).withColumn("GATE_CASE", F.lit(name))
        out = v if out is None else out.unionByName(v)
    return present(out.withColumn("OLD_TOTAL_SPEND", F.round(F.col("OLD_TOTAL_SPEND"), 2)))


def _earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign table that a run one quarter earlier published: an input of the gate, so it is staged
    once a session as the other inputs are."""
    cfg = fixtures.fixture_config()
    earlier = cfg.with_window(cfg.window.shifted(GATE_PASS_SHIFT_DAYS))

    def make(scratch: Scratch) -> DataFrame:
        stages = build(fixtures.load(spark, sf_dir), earlier, scratch)
        return scratch.write(to_published(stages.campaign), "published")

    return fixtures.staged(spark, sf_dir, "previous", make)


def q19_regression_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations for two previous publications: a run one quarter earlier (passes) and the
    current run with one application's installs doubled (fails for that application)."""
    current = _stages(spark, sf_dir, campaign_twice=True)
    cases = {"pass": _earlier(spark, sf_dir), "fail": _failing(current)}
    # games of the campaign table are those of the channel table, which sums it
    return _gate_cases(cases, lambda previous: regression_violations(previous, current.campaign).drop("FAILED_RULES"))


def q24_gate_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's full outcome, spend rule included, for the same publication again (every game
    passes, though it holds 32-bit floats) and for the failing one."""
    current = _stages(spark, sf_dir, campaign_twice=True)
    cases = {"same": to_published(current.campaign), "fail": _failing(current)}
    return _gate_cases(cases, lambda previous: gate_outcome(previous, current.campaign))


# -- X13 / X14 -----------------------------------------------------------------------------


def q20_published_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_published(_stages(spark, sf_dir).campaign)


def _output_digests(df: DataFrame, keys, label: dict[str, str]) -> DataFrame:
    """Per application: row count, metric sums and the portable digests of keys and rows."""
    sums = df.groupBy(C.APP).agg(
        *[F.sum(m).cast("long").alias(m) for m in C.COUNT_METRICS],
        *[F.round(F.sum(F.col(m).cast(C.METRIC_DECIMAL)), 2).alias(m) for m in C.MONEY_METRICS],
    )
    found = digests(df, keys, portable=True).select(
        C.APP, "ROW_COUNT", *[F.col(c).cast("string").alias(c) for c in ("KEY_DIGEST", "ROW_DIGEST")]
    )
    return found.join(sums, C.APP).withColumns({k: F.lit(v) for k, v in label.items()})


def _union(parts) -> DataFrame:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def _targets(root: str, cfg: C.JobConfig) -> dict[str, PublishTarget]:
    suffix = root.rsplit("-", 1)[-1]
    return {
        name: PublishTarget(
            table=f"spendlens_{name}_{suffix}",
            snapshot_path=f"{root}/{name}_{cfg.window.stamp()}.parquet",
            table_path=f"{root}/tables/{name}",
        )
        for name in OUTPUT_KEYS
    }


def _read_back(spark: SparkSession, targets: dict[str, PublishTarget]) -> DataFrame:
    """Both catalog tables and both dated snapshots, by application."""
    parts = []
    for name, target in targets.items():
        for kind, df in (("table", spark.table(target.table)), ("snapshot", spark.read.parquet(target.snapshot_path))):
            parts.append(_output_digests(df, OUTPUT_KEYS[name], {"OUTPUT": f"{name}_{kind}"}))
    return present(_union(parts))


OUTPUT_KEYS = {"campaign": C.CAMPAIGN_KEYS, "channel": C.KCH}


def q21_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish campaign and channel tables under a fresh folder of shared storage, and read
    every output back: both catalog tables and both dated snapshots, each by application as its row count, the
    sum of every published metric and digests of its keys and rows."""
    cfg = fixtures.fixture_config()
    stages = _stages(spark, sf_dir, cfg, campaign_twice=True)
    targets = _targets(Scratch(spark).root, cfg)
    publish(spark, stages.campaign, stages.channel, *targets.values())
    return _read_back(spark, targets)


def q30_published_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cast policy "reject" on counts scaled beyond 32 bits: every row with its status, the metrics
    that did not fit, and its installs as they are published or rejected."""
    campaign = _stages(spark, sf_dir, campaign_twice=True).campaign
    scaled = campaign.withColumns({m: (F.col(m) * REJECT_SCALE).cast(C.METRIC_DECIMAL) for m in C.COUNT_METRICS})
    columns = [*C.CAMPAIGN_KEYS, F.col(C.INSTALL).cast("double").alias(C.INSTALL)]
    good = to_published(scaled, "reject").select(*columns, F.lit("published").alias("STATUS"), F.lit("").alias(REJECTED))
    bad = rejected_rows(scaled).select(*columns, F.lit("rejected").alias("STATUS"), F.array_join(REJECTED, ",").alias(REJECTED))
    return good.union(bad)


#: counts times this exceed 32 bits from 108 on
REJECT_SCALE = 20_000_000


def q31_application_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published run, then a run of one application with corrected day-14 and day-28 revenue that replaces only
    its partitions: all four outputs read back by application."""
    cfg = fixtures.fixture_config()
    first = _stages(spark, sf_dir, cfg, campaign_twice=True)
    again = _stages(spark, sf_dir, replace(cfg, legacy_day1_override=False), campaign_twice=True)
    targets = _targets(Scratch(spark).root, cfg)
    publish(spark, first.campaign, first.channel, *targets.values())
    publish(spark, again.campaign, again.channel, *targets.values(), only=(cfg.tiers.tier_c,))
    return _read_back(spark, targets)


def q36_joint_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs published jointly and a rollback to the first: each version, and what the views show then."""
    cfg = fixtures.fixture_config()
    root = Scratch(spark).root
    suffix = root.rsplit("-", 1)[-1]
    joint = job_publication(spark, root, f"spendlens_campaign_view_{suffix}", f"spendlens_channel_view_{suffix}")
    versions = {}
    for label, window in (("earlier", cfg.window.shifted(GATE_PASS_SHIFT_DAYS)), ("current", cfg.window)):
        stages = _stages(spark, sf_dir, cfg.with_window(window), campaign_twice=True)
        channel = Scratch(spark).write(stages.channel, "channel")
        tables = {"campaign": to_published(stages.campaign), "channel": to_published(channel)}
        versions[label] = joint.publish(tables, window.stamp()).version
    joint.rollback(versions["earlier"])
    parts = []
    for name, output in joint.outputs.items():
        parts += [_output_digests(joint.read(name, v), output.keys, {"OUTPUT": name, "SHOWN": label}) for label, v in versions.items()]
        parts.append(_output_digests(spark.table(output.view), output.keys, {"OUTPUT": name, "SHOWN": "view"}))
    return present(_union(parts))


# -- X2 / X16 ------------------------------------------------------------------------------


def q22_channel_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold mapping in use: fact side with channel aliases, install side without."""
    src, cfg = _inputs(spark, sf_dir)

    def mapping(df: DataFrame, side: str, alias) -> DataFrame:
        raw = df.select(
            C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION, F.col(C.CHANNEL).alias("RAW_CHANNEL_NAME")
        )
        folded = fold_organic(raw, cfg.paid_source_types, alias)
        return (
            folded.groupBy(C.SOURCE_TYPE, "RAW_CHANNEL_NAME", C.CHANNEL, C.PROMOTION)
            .agg(F.count(F.lit(1)).alias("ROW_COUNT"))
            .withColumn("SIDE", F.lit(side))
        )

    return mapping(src.fact, "fact", cfg.channel_alias).unionByName(
        mapping(src.installs, "install", None)
    )


def q23_reporting_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each input per reporting-window class of the fixture run."""
    src, cfg = _inputs(spark, sf_dir)
    w = cfg.window

    def classes(df: DataFrame, table: str, date_col: str, classify) -> DataFrame:
        return (
            df.select(classify(F.col(date_col), w).alias("WINDOW_CLASS"), F.col(date_col))
            .groupBy("WINDOW_CLASS")
            .agg(
                F.count(F.lit(1)).alias("ROW_COUNT"),
                F.min(date_col).alias("MIN_DT"),
                F.max(date_col).alias("MAX_DT"),
            )
            .withColumn("TABLE_NAME", F.lit(table))
        )

    return (
        classes(src.fact, "fact", C.DATE, mmp_window_class)
        .unionByName(classes(src.installs, "install", "INSTALL_DT", mmp_window_class))
        .unionByName(classes(src.skan, "skan", "INSTALL_DT", skan_window_class))
    )


# -- variants ------------------------------------------------------------------------------


def q25_precedence_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched SKAN campaigns under the "collapse" fan-out policy: one row per campaign."""
    src, cfg = _inputs(spark, sf_dir)
    joined = precedence_join(_details(src, cfg), skan_rollup(src.skan, cfg))
    return present(enriched_rows(joined, collapse=True))


def q26_net_by_card_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription revenue (q04) with the shares in an effective-dated card table."""
    src, cfg = _inputs(spark, sf_dir)
    gross = {f"SUBSCRIPTIONS_REVS_DAY_{d:03d}_AMT": f"SUB_REVS_DAY_{d:03d}_AMT" for d in C.REVENUE_DAYS}
    types = column_types(src.fact)
    sums = scope_fact(src.fact, cfg).groupBy(*C.K3).agg(*[rated(group_sum(types, c), c) for c in gross])
    return present(net_by_card(sums, subscription_cards(spark, cfg), "SUB", gross))


def _book(spark: SparkSession, cfg: C.JobConfig) -> CardBook:
    return CardBook(configured_cards(spark, cfg), cfg)


def q27_campaign_rollup_by_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q01 with every share from the card table."""
    src, cfg = _inputs(spark, sf_dir)
    return present(campaign_rollup(src.fact, cfg, _book(spark, cfg)))


def q28_install_ltv_by_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q06 with every share from the card table."""
    src, cfg = _inputs(spark, sf_dir)
    return present(install_ltv_rollup(src.installs, src.projections, cfg, _book(spark, cfg)))


def q29_skan_by_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q08 with every share from the card table."""
    src, cfg = _inputs(spark, sf_dir)
    return present(skan_rollup(src.skan, cfg, _book(spark, cfg)))


def q32_install_ltv_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q06 on user-level inputs that are bucketed on the user key."""
    src, cfg = _inputs(spark, sf_dir)
    root = Scratch(spark).root
    suffix = root.rsplit("-", 1)[-1]
    own = bucketed_sources(src, f"spendlens_installs_{suffix}", f"spendlens_projections_{suffix}", location=root)
    return present(install_ltv_rollup(own.installs, own.projections, cfg))


def q33_gate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate by a rule table, on the failing publication of q24 and on that of a run one quarter earlier: every game
    with the rules it fails. The published job's rules, the spend rule, and growth rules of one market."""
    current = _stages(spark, sf_dir, campaign_twice=True)
    rules = rules_from_table(rule_table(spark, GATE_RULES))
    cases = {"earlier": _earlier(spark, sf_dir), "fail": _failing(current)}
    judged = _gate_cases(cases, lambda previous: gate_by_rules(previous, current.campaign, rules))
    return judged.withColumn("FAILED_RULES", F.array_join("FAILED_RULES", ","))


GATE_RULES = (
    DATE_RULE,
    INSTALL_RULE,
    SPEND_RULE,
    GateRule("INSTALLS_GREW", "TOTAL_INSTALL", "share_not_above", Decimal("0.02"), (None, C.GOOGLE_MARKET, None)),
    GateRule("DATE_AHEAD", "LAST_INSTALL_DT", "not_above", Decimal(31), (None, None, C.SKAN_SOURCE)),
)


def q34_latest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each user's latest projections the one with the largest subscription revenue, then the largest others."""
    src, _ = _inputs(spark, sf_dir)
    return present(
        latest_per_key(src.projections, C.USER_KEY, "PROJECTION_DT", ties="one", tie_break=["SUB_PROJECTEDREVENUE_365"])
    )


def q35_install_ltv_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q06 without installs of the channels that the fact side excludes."""
    src, cfg = _inputs(spark, sf_dir)
    cfg = replace(cfg, install_excluded_channel_pattern=cfg.excluded_channel_pattern)
    return present(install_ltv_rollup(src.installs, src.projections, cfg))


QUERIES: dict[str, QueryFn] = {
    "q01_campaign_rollup": q01_campaign_rollup,
    "q02_net_iap": q02_net_iap,
    "q03_net_ad": q03_net_ad,
    "q04_net_subscription": q04_net_subscription,
    "q05_latest_projection": q05_latest_projection,
    "q06_install_ltv": q06_install_ltv,
    "q07_campaign_details": q07_campaign_details,
    "q08_skan_rollup": q08_skan_rollup,
    "q09_precedence_enrich": q09_precedence_enrich,
    "q10_precedence_remainder": q10_precedence_remainder,
    "q11_ios_total": q11_ios_total,
    "q12_ios_paid": q12_ios_paid,
    "q13_skan_total": q13_skan_total,
    "q14_residual_raw": q14_residual_raw,
    "q15_clamp": q15_clamp,
    "q16_complete_campaign": q16_complete_campaign,
    "q17_channel_rollup": q17_channel_rollup,
    "q18_game_rollup": q18_game_rollup,
    "q19_regression_violations": q19_regression_violations,
    "q20_published_schema": q20_published_schema,
    "q21_sink_roundtrip": q21_sink_roundtrip,
    "q22_channel_fold": q22_channel_fold,
    "q23_reporting_window": q23_reporting_window,
    "q24_gate_outcome": q24_gate_outcome,
    "q25_precedence_collapse": q25_precedence_collapse,
    "q26_net_by_card_table": q26_net_by_card_table,
    "q27_campaign_rollup_by_cards": q27_campaign_rollup_by_cards,
    "q28_install_ltv_by_cards": q28_install_ltv_by_cards,
    "q29_skan_by_cards": q29_skan_by_cards,
    "q30_published_rejects": q30_published_rejects,
    "q31_application_rerun": q31_application_rerun,
    "q32_install_ltv_bucketed": q32_install_ltv_bucketed,
    "q33_gate_rules": q33_gate_rules,
    "q34_latest_single": q34_latest_single,
    "q35_install_ltv_filtered": q35_install_ltv_filtered,
    "q36_joint_publication": q36_joint_publication,
}

"""X15: the daily attribution run, from the four inputs to the two published tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..functions.cards import CardBook, conformed_cards
from ..operators.merge import merge_details
from ..operators.precedence import (
    assert_no_fanout,
    enriched_rows,
    precedence_join,
    remainder_rows,
)
from ..operators.publication import Commit, Publication
from ..operators.publish import PublishTarget, publish, rejected_rows, to_published
from ..operators.quality import GateRule, assert_no_regression
from ..operators.reconcile import assemble_campaign
from ..operators.rollup import (
    campaign_rollup,
    channel_rollup,
    install_ltv_rollup,
    skan_rollup,
)
from ..session import Scratch, require_ansi
from ..sources.catalog import Sources


@dataclass
class Stages:
    """Intermediate relations of one run, read from its scratch relations."""

    details: DataFrame
    skan: DataFrame
    enriched: DataFrame
    remainder: DataFrame
    campaign: DataFrame
    channel: DataFrame


@dataclass
class RunReport:
    """What a run published: the commit of a joint publication, and how many rows each output rejected."""

    commit: Commit | None = None
    rejected: dict[str, int] = field(default_factory=dict)


def build(
    sources: Sources, cfg: C.JobConfig, scratch: Scratch, write_campaign: bool = False, cards: DataFrame | None = None
) -> Stages:
    """Compose the operators. Shares are the configured ones, or those of the table ``cards``.

    The campaign details are read by the iOS join, the Google branch and the residual, and the
    join by enrichment, anti join and residual: each is written once to ``scratch`` and read from
    there. ``write_campaign`` also writes the complete campaign table, for callers that read
    it twice (publish and the channel roll-up). Everything else stays lazy.
    """
    require_ansi(scratch.spark)
    if cfg.fanout not in ("keep", "collapse", "error"):
        raise ValueError(f"unknown fanout policy {cfg.fanout!r}")
    book = CardBook(scratch.write(conformed_cards(cards), "cards"), cfg) if cards is not None else None
    details = scratch.write(
        merge_details(
            campaign_rollup(sources.fact, cfg, book),
            install_ltv_rollup(sources.installs, sources.projections, cfg, book),
        ),
        "details",
    )
    skan = skan_rollup(sources.skan, cfg, book)
    joined = scratch.write(precedence_join(details, skan), "precedence")
    if cfg.fanout == "error":
        assert_no_fanout(joined)
    enriched = enriched_rows(joined, collapse=cfg.fanout == "collapse")
    remainder = remainder_rows(joined, details)
    campaign = assemble_campaign(details, enriched, remainder, cfg)
    if write_campaign:
        campaign = scratch.write(campaign, "campaign")
    channel = channel_rollup(campaign)
    return Stages(details, skan, enriched, remainder, campaign, channel)


def run(
    spark: SparkSession,
    sources: Sources,
    cfg: C.JobConfig,
    campaign_target: PublishTarget | None = None,
    channel_target: PublishTarget | None = None,
    policy: str = "legacy",
    check_spend: bool = False,
    *,
    cards: DataFrame | None = None,
    rules: Sequence[GateRule] | None = None,
    publication: Publication | None = None,
    rejects: str | None = None,
    only: Sequence[str] | None = None,
) -> RunReport:
    """Build, gate against the previous publication, then publish.

    ``publication`` replaces both tables together; targets are written one after the other (``only``: the partitions
    of those applications alone). ``cards`` and ``rules`` are the share and gate-rule tables, if they are not the
    configured ones. Under the policy ``reject`` rows that do not fit the published types go to the folder
    ``rejects``, which is needed then, and the rest is published.

    The run's scratch relations are deleted however it ends; what it made is in the targets.
    """
    if (policy == "reject") != (rejects is not None):
        raise ValueError("a folder for rejected rows belongs to the policy 'reject'")
    if publication is not None and only is not None:
        raise ValueError("a joint publication replaces whole tables")
    scratch = Scratch(spark)
    report = RunReport()
    try:
        stages = build(sources, cfg, scratch, write_campaign=True, cards=cards)
        channel = scratch.write(stages.channel, "channel")
        assert_no_regression(sources.previous, channel, check_spend, rules)
        for name, df in (("campaign", stages.campaign), ("channel", channel)):
            if rejects is not None:
                path = f"{rejects.rstrip('/')}/{name}_{cfg.window.stamp()}"
                rejected_rows(df).write.mode("overwrite").parquet(path)
                report.rejected[name] = spark.read.parquet(path).count()
        if publication is not None:
            tables = {"campaign": to_published(stages.campaign, policy), "channel": to_published(channel, policy)}
            report.commit = publication.publish(tables, cfg.window.stamp())
        if campaign_target is not None and channel_target is not None:
            publish(spark, stages.campaign, channel, campaign_target, channel_target, policy, only)
    finally:
        scratch.release()
    return report

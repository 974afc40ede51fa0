"""Command line for the daily run: ``python -m spendlens.plans.cli --help``.

Reads the four input tables and the previous campaign publication from the catalog, gates
the new result against it, and publishes the campaign and channel tables plus their dated
Parquet snapshots. Every deployment detail (table names, applications, licensing tiers,
snapshot folder) is an argument.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from .. import config as C
from ..operators.publication import job_publication
from ..operators.publish import PublishTarget
from ..operators.quality import rules_from_table
from ..sources.catalog import Sources, TableNames
from .pipeline import run


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spendlens", description=__doc__)
    p.add_argument("--fact", required=True, help="campaign expense fact table")
    p.add_argument("--projections", required=True, help="per-user LTV projection history table")
    p.add_argument("--installs", required=True, help="install table")
    p.add_argument("--skan", required=True, help="SKAN postback LTV table")
    p.add_argument("--campaign-table", required=True)
    p.add_argument("--channel-table", required=True)
    p.add_argument("--snapshot-dir", help="folder for dated Parquet snapshots (omit: no publish)")
    p.add_argument("--apps", required=True, help="comma-separated application names")
    p.add_argument("--tier-a", help="application with the tier-a share table")
    p.add_argument("--tier-b", help="application with the tier-b share table")
    p.add_argument("--tier-c", help="application with the tier-c share table")
    p.add_argument("--run-date", type=_date, default=dt.date.today())
    p.add_argument("--start", type=_date, default=C.DEFAULT_START)
    p.add_argument("--delay-days", type=int, default=C.REPORT_DELAY_DAYS)
    p.add_argument("--google-reduced-fee-from", type=_date, default=C.GOOGLE_REDUCED_FEE_FROM)
    p.add_argument("--policy", choices=("legacy", "clean", "reject"), default="legacy")
    p.add_argument("--rejects-dir", help="folder for rows that do not fit the published types (--policy reject)")
    p.add_argument("--cards", help="share-card table (default: the configured shares)")
    p.add_argument("--gate-rules", help="gate-rule table (default: the published job's rules)")
    p.add_argument("--publish-dir", help="folder of a joint publication: --campaign-table and --channel-table are its views")
    p.add_argument("--replace-apps", action="store_true", help="replace the partitions of --apps alone in every output")
    p.add_argument("--format", default="parquet", help="format of the catalog tables")
    p.add_argument("--table-dir", help="location of the catalog tables (default: managed)")
    p.add_argument("--alias-install-channels", action="store_true", help="apply channel aliases to installs too")
    p.add_argument("--install-excluded-channels", help="pattern of channels whose installs do not count")
    p.add_argument("--install-campaign-type", help="campaign type that installs must have")
    p.add_argument("--markets", default=",".join(C.MARKETS), help="comma-separated market codes")
    p.add_argument("--fanout", choices=("keep", "collapse", "error"), default="keep",
                   help="SKAN campaigns that match several MMP source types")
    p.add_argument("--check-spend", action="store_true", help="gate on spend too")
    p.add_argument("--clean", action="store_true", help="corrected preset (no legacy quirks)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.publish_dir and (args.snapshot_dir or args.replace_apps):
        parser().error("--publish-dir stands alone: a version has every application, and is its own snapshot")
    spark = spark or SparkSession.builder.getOrCreate()
    cfg = C.JobConfig(
        apps=tuple(a.strip() for a in args.apps.split(",") if a.strip()),
        window=C.ReportWindow(start=args.start, as_of=args.run_date, delay_days=args.delay_days),
        tiers=C.RoyaltyTiers(args.tier_a, args.tier_b, args.tier_c),
        google_reduced_fee_from=args.google_reduced_fee_from,
        markets=tuple(m.strip() for m in args.markets.split(",") if m.strip()),
        fanout=args.fanout,
        alias_install_channels=args.alias_install_channels,
        install_excluded_channel_pattern=args.install_excluded_channels,
        install_campaign_type=args.install_campaign_type,
    )
    if args.clean:
        cfg = cfg.clean()
    names = TableNames(
        fact=args.fact,
        projections=args.projections,
        installs=args.installs,
        skan=args.skan,
        campaign_table=args.campaign_table,
        channel_table=args.channel_table,
    )
    sources = Sources.from_tables(spark, names)
    targets = (None, None)
    if args.snapshot_dir:
        stamp = cfg.window.stamp()
        base = args.snapshot_dir.rstrip("/")
        location = (lambda name: f"{args.table_dir.rstrip('/')}/{name}") if args.table_dir else lambda name: None
        targets = tuple(
            PublishTarget(table, f"{base}/{name}_{stamp}.parquet", location(name), args.format)
            for name, table in (("campaign", names.campaign_table), ("channel", names.channel_table))
        )
    joint = job_publication(spark, args.publish_dir, names.campaign_table, names.channel_table) if args.publish_dir else None
    report = run(
        spark,
        sources,
        cfg,
        *targets,
        policy=args.policy,
        check_spend=args.check_spend,
        cards=spark.table(args.cards) if args.cards else None,
        rules=rules_from_table(spark.table(args.gate_rules)) if args.gate_rules else None,
        publication=joint,
        rejects=args.rejects_dir,
        only=cfg.apps if args.replace_apps else None,
    )
    for name, n in report.rejected.items():
        print(f"{name}: {n} row(s) rejected, in {args.rejects_dir}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

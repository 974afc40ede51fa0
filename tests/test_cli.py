"""The command line runs the whole job against catalog names and publishes both tables."""

from __future__ import annotations

import tempfile

from conftest import SMOKE_DIR

from spendlens import config as C
from spendlens.plans.cli import main
from spendlens.plans.queries import q20_published_schema
from spendlens.sources import fixtures


def _args(snap: str, run_date: str) -> list[str]:
    return [
        "--fact", "cli_fact", "--projections", "cli_projections", "--installs", "cli_installs",
        "--skan", "cli_skan", "--campaign-table", "cli_campaign", "--channel-table", "cli_channel",
        "--snapshot-dir", snap, "--apps", ",".join(fixtures.FIXTURE_APPS),
        "--tier-a", "ECONOMY", "--tier-b", "PROMO", "--tier-c", "SMALL",
        "--run-date", run_date, "--start", "1995-04-01", "--google-reduced-fee-from", "1998-01-01",
    ]


def test_cli_publishes_and_gates(spark):
    src = fixtures.load(spark, SMOKE_DIR)
    for name, df in (
        ("cli_fact", src.fact), ("cli_projections", src.projections),
        ("cli_installs", src.installs), ("cli_skan", src.skan),
    ):
        df.createOrReplaceTempView(name)
    snap = tempfile.mkdtemp(prefix="spendlens-cli-")
    assert main(_args(snap, "2001-07-02"), spark) == 0  # first run: no previous table
    published = spark.table("cli_campaign")
    expected = q20_published_schema(spark, SMOKE_DIR)
    cols = sorted(published.columns)
    assert sorted(map(tuple, published.select(cols).collect())) == sorted(
        map(tuple, expected.select(cols).collect())
    )
    assert C.PROMOTION not in spark.table("cli_channel").columns
    assert spark.read.parquet(f"{snap}/campaign_2001-07-02.parquet").count() == published.count()
    # the next day reads the table just published as the previous run and passes the gate
    assert main(_args(snap, "2001-07-03"), spark) == 0


def test_cli_joint_publication_cards_and_rules(spark):
    from spendlens.functions.cards import configured_cards
    from spendlens.operators.quality import DATE_RULE, INSTALL_RULE, rule_table

    src = fixtures.load(spark, SMOKE_DIR)
    for name, df in (
        ("cli_fact", src.fact), ("cli_projections", src.projections),
        ("cli_installs", src.installs), ("cli_skan", src.skan),
    ):
        df.createOrReplaceTempView(name)
    configured_cards(spark, fixtures.fixture_config()).createOrReplaceTempView("cli_cards")
    rule_table(spark, (DATE_RULE, INSTALL_RULE)).createOrReplaceTempView("cli_rules")
    root = tempfile.mkdtemp(prefix="spendlens-cli-joint-")
    args = _args(root, "2001-07-02")
    args[args.index("--snapshot-dir")] = "--publish-dir"
    args[args.index("cli_campaign")], args[args.index("cli_channel")] = "cli_campaign_view", "cli_channel_view"
    args += ["--cards", "cli_cards", "--gate-rules", "cli_rules", "--policy", "reject", "--rejects-dir", f"{root}/rejects"]
    assert main(args, spark) == 0
    view = spark.table("cli_campaign_view")
    expected = q20_published_schema(spark, SMOKE_DIR)
    cols = sorted(expected.columns)
    assert sorted(map(tuple, view.select(cols).collect())) == sorted(map(tuple, expected.select(cols).collect()))
    args[args.index("2001-07-02")] = "2001-07-03"
    assert main(args, spark) == 0  # gated against the view
    for v in ("cli_campaign_view", "cli_channel_view"):
        spark.sql(f"DROP VIEW {v}")


def test_cli_replaces_one_application(spark):
    src = fixtures.load(spark, SMOKE_DIR)
    for name, df in (
        ("cli_fact", src.fact), ("cli_projections", src.projections),
        ("cli_installs", src.installs), ("cli_skan", src.skan),
    ):
        df.createOrReplaceTempView(name)
    root = tempfile.mkdtemp(prefix="spendlens-cli-part-")
    args = _args(f"{root}/snapshots", "2001-07-02")
    args[args.index("cli_campaign")], args[args.index("cli_channel")] = "cli_part_campaign", "cli_part_channel"
    args += ["--table-dir", f"{root}/tables", "--format", "parquet"]
    assert main(args, spark) == 0
    before = {tuple(r) for r in spark.table("cli_part_campaign").collect()}
    args[args.index("--apps") + 1] = "SMALL"
    assert main([*args, "--replace-apps", "--clean"], spark) == 0
    after = {tuple(r) for r in spark.table("cli_part_campaign").collect()}
    at = spark.table("cli_part_campaign").columns.index(C.APP)
    changed = {r[at] for r in before ^ after}
    assert changed == {"SMALL"} and {r[at] for r in after} == {r[at] for r in before}
    for t in ("cli_part_campaign", "cli_part_channel"):
        spark.sql(f"DROP TABLE {t}")

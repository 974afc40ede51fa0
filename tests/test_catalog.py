"""The source boundary: spelling, dates, missing columns, changed files."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from spendlens.operators.publish import to_published
from spendlens.operators.rollup import campaign_rollup, install_ltv_rollup, skan_rollup
from spendlens.plans.pipeline import build
from spendlens.session import Scratch
from spendlens.sources import fixtures
from spendlens.sources.catalog import Sources, conformed


def _results(spark, src):
    cfg = fixtures.fixture_config()
    frames = [
        campaign_rollup(src.fact, cfg),
        install_ltv_rollup(src.installs, src.projections, cfg),
        skan_rollup(src.skan, cfg),
        to_published(build(src, cfg, Scratch(spark)).campaign),
    ]
    return [sorted(map(str, f.collect())) for f in frames]


def _with(src, change):
    return Sources(*(change(getattr(src, n)) for n in ("fact", "installs", "projections", "skan")))


def test_spelling_and_timestamps_do_not_matter(spark):
    src = fixtures.load(spark, SMOKE_DIR)
    want = _results(spark, src)
    mixed = lambda c: "".join(x.upper() if i % 3 else x.lower() for i, x in enumerate(c))

    def evening(df):
        days = [n for n, t in df.dtypes if t == "date"]
        return df.withColumns({n: F.col(n).cast("timestamp") + F.expr("INTERVAL 22 HOURS") for n in days})

    for change in (
        lambda df: df.toDF(*map(str.lower, df.columns)),
        lambda df: df.toDF(*map(mixed, df.columns)),
        lambda df: df.select("*", F.lit(1).alias("unknown_column")),
        evening,
    ):
        assert _results(spark, _with(src, change)) == want


def test_missing_and_ambiguous_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing C"):
        conformed(df, ("A", "C"), "t")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        twice = spark.createDataFrame([(1, 2)], "a int, A int")
        with pytest.raises(ValueError, match="ambiguous A"):
            conformed(twice, ("A",), "t")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_changed_source_files_are_seen(spark, tmp_path):
    for t in ("lineitem", "orders", "customer", "part"):
        spark.read.parquet(f"{SMOKE_DIR}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    first = fixtures.load(spark, str(tmp_path)).projections.count()
    assert fixtures.load(spark, str(tmp_path)).projections.count() == first
    spark.read.parquet(f"{SMOKE_DIR}/orders.parquet").limit(10).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert fixtures.load(spark, str(tmp_path)).projections.count() == 10


def test_card_table_takes_new_applications_and_rates(spark):
    from decimal import Decimal

    from spendlens.functions.cards import SCHEMA, net_by_card

    d = dt.date
    sums = spark.createDataFrame(
        [("NEW", "IT", d(2022, 1, 1), Decimal(100)), ("NEW", "IT", d(2023, 1, 1), Decimal(100)), ("X", "IT", d(2022, 1, 1), Decimal(7)), ("NEW", "IT", d(2021, 1, 1), None)],
        "APPLICATION_FAMILY_NAME string, MARKET_CD string, CALENDAR_DT date, G decimal(10,2)",
    )
    cards = spark.createDataFrame(
        [("SUB", "NEW", "IT", d(1, 1, 1), d(2023, 1, 1), Decimal("0.5")), ("SUB", "NEW", "IT", d(2023, 1, 1), d(9999, 12, 31), Decimal("0.9")), ("IAP", "X", "IT", d(1, 1, 1), d(9999, 12, 31), Decimal("0.1"))],
        SCHEMA,
    )
    got = sorted((r.APPLICATION_FAMILY_NAME, r.CALENDAR_DT, r.N) for r in net_by_card(sums, cards, "SUB", {"G": "N"}).collect())
    assert got == [("NEW", d(2021, 1, 1), 0), ("NEW", d(2022, 1, 1), 50), ("NEW", d(2023, 1, 1), 90), ("X", d(2022, 1, 1), 0)]

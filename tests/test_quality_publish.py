"""X11-X14: game roll-up, regression gate, published schema, sinks."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import types as T

from spendlens import config as C
from spendlens.operators.publish import PublishTarget, publish, to_published
from spendlens.operators.quality import QualityGateError, assert_no_regression, regression_violations

D1, D2 = dt.date(2022, 1, 1), dt.date(2022, 2, 1)
SCHEMA = "APPLICATION_FAMILY_NAME string, MARKET_CD string, SOURCE string, CALENDAR_DT date, SPEND double, INSTALL long"


def test_gate_rules(spark):
    old = spark.createDataFrame(
        [
            ("A", "IT", "SKAN", D2, 10.0, 100),
            ("B", "IT", "SKAN", D2, 10.0, 100),
            ("C", "IT", "SKAN", D2, 10.0, 100),
            ("ONLY_OLD", "IT", "SKAN", D2, 10.0, 100),
        ],
        SCHEMA,
    )
    new = spark.createDataFrame(
        [
            ("A", "IT", "SKAN", D2, 1.0, 99),  # exactly -1: passes; lower spend is not checked
            ("B", "IT", "SKAN", D2, 10.0, 98),  # -2: fails
            ("C", "IT", "SKAN", D1, 10.0, 200),  # date went back: fails
            ("ONLY_NEW", "IT", "SKAN", D1, 0.0, 0),  # not on both sides: unchecked
        ],
        SCHEMA,
    )
    bad = sorted(r.APPLICATION_FAMILY_NAME for r in regression_violations(old, new).collect())
    assert bad == ["B", "C"]
    with_spend = sorted(r.APPLICATION_FAMILY_NAME for r in regression_violations(old, new, True).collect())
    assert with_spend == ["A", "B", "C"]
    with pytest.raises(QualityGateError) as e:
        assert_no_regression(old, new)
    assert e.value.total == 2 and "2 game(s) regressed" in str(e.value)
    assert_no_regression(None, new)  # first run passes
    assert_no_regression(old.where("APPLICATION_FAMILY_NAME = 'A'"), new)


def _campaign(spark):
    fields = [T.StructField(k, T.StringType()) for k in C.CAMPAIGN_KEYS[:-1]]
    fields += [T.StructField(C.DATE, T.DateType())]
    fields += [T.StructField(m, C.METRIC_DECIMAL) for m in C.METRICS]
    from decimal import Decimal

    vals = [Decimal("16777217.75")] * len(C.METRICS)
    rows = [("A", "IT", "SKAN", "MK", "X", "P", D1, *vals), ("B", "GO", "Non-SKAN", "US", "ORGANIC", "ORGANIC", D2, *vals)]
    return spark.createDataFrame(rows, T.StructType(fields))


def test_published_schema(spark):
    legacy = to_published(_campaign(spark))
    types = dict(legacy.dtypes)
    assert all(types[m] == "float" for m in C.MONEY_METRICS)
    assert all(types[m] == "int" for m in C.COUNT_METRICS)
    r = legacy.collect()[0]
    assert r.SPEND == 16777218.0  # 32-bit float rounding
    assert r.INSTALL == 16777217  # int truncates
    clean = dict(to_published(_campaign(spark), "clean").dtypes)
    assert clean["SPEND"] == C.METRIC_DECIMAL.simpleString()


def test_sink_roundtrip_and_rerun(spark):
    root = tempfile.mkdtemp(prefix="spendlens-sink-")
    df = _campaign(spark)
    tgt_c = PublishTarget("t_campaign_rt", f"{root}/campaign_2022-02-01.parquet", f"{root}/tables/campaign")
    tgt_h = PublishTarget("t_channel_rt", f"{root}/channel_2022-02-01.parquet", f"{root}/tables/channel")
    for _ in range(2):  # idempotent rerun
        publish(spark, df, df.drop(C.PROMOTION), tgt_c, tgt_h)
        back = spark.table("t_campaign_rt")
        assert back.count() == 2
        parts = sorted(n for n in os.listdir(f"{root}/campaign_2022-02-01.parquet") if "=" in n)
        assert parts == [
            "APPLICATION_FAMILY_NAME=A",
            "APPLICATION_FAMILY_NAME=B",
        ]
        snap = spark.read.parquet(f"{root}/channel_2022-02-01.parquet")
        assert C.PROMOTION not in snap.columns and snap.count() == 2
    assert dict(back.dtypes)["SPEND"] == "float"


def test_every_violation_is_counted_and_kept(spark):
    rows = [(f"APP{i:02d}", "IT", "SKAN", D2, 10.0, 100) for i in range(50)]
    old, new = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(*r[:5], 1) for r in rows], SCHEMA)
    with pytest.raises(QualityGateError) as e:
        assert_no_regression(old, new)
    assert e.value.total == 50 and "First 20 of 50" in str(e.value)
    assert [r.APPLICATION_FAMILY_NAME for r in e.value.shown] == [f"APP{i:02d}" for i in range(20)]
    assert spark.read.parquet(e.value.path).count() == 50


def test_unchanged_publication_passes_the_spend_rule(spark):
    """16777217.75 is published as the 32-bit float 16777218: no drop."""
    df = _campaign(spark)
    assert_no_regression(to_published(df), df, check_spend=True)


def test_incomplete_tables_are_not_published(spark):
    with pytest.raises(ValueError, match="SPEND"):
        to_published(_campaign(spark).drop("SPEND"))


def test_failure_of_the_second_table_leaves_complete_snapshots(spark, monkeypatch):
    """What readers see then: the new campaign table, the previous channel table, both snapshots."""
    from spendlens.operators import publish as P

    root = tempfile.mkdtemp(prefix="spendlens-fail-")
    target = lambda name, day: PublishTarget(f"fail_{name}", f"{root}/{name}_{day}.parquet", f"{root}/t/{name}")
    df = _campaign(spark)
    publish(spark, df, df.drop(C.PROMOTION), target("campaign", 1), target("channel", 1))
    bigger = df.union(df)
    write, calls = P.write_table, []

    def second_fails(spark, path, t):
        calls.append(t.table)
        if len(calls) == 2:
            raise OSError("disk full")
        write(spark, path, t)

    monkeypatch.setattr(P, "write_table", second_fails)
    with pytest.raises(OSError):
        publish(spark, bigger, bigger.drop(C.PROMOTION), target("campaign", 2), target("channel", 2))
    assert spark.table("fail_campaign").count() == 4 and spark.table("fail_channel").count() == 2
    assert spark.read.parquet(f"{root}/channel_2.parquet").count() == 4
    monkeypatch.setattr(P, "write_table", write)
    P.write_table(spark, f"{root}/channel_2.parquet", target("channel", 2))
    assert spark.table("fail_channel").count() == 4

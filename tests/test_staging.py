"""How the fixture inputs are staged: what crosses the network, and the rows of odd tables."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
from collections import Counter

import pytest
from conftest import SMOKE_DIR, D

from spendlens import config as C
from spendlens.session import Scratch
from spendlens.sources import fixtures


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_dealt_out_again_for_a_write(spark, monkeypatch):
    """No relation of the staged inputs has an exchange besides those of its joins."""
    own, written, write = spark.newSession(), {}, Scratch.write

    def record(self, df, name):
        written[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(Scratch, "write", record)
    fixtures.load(own, SMOKE_DIR)
    fixtures.release(own)
    assert set(written) == {"dims", "fact", "installs", "projections", "skan"}
    assert not any(re.search("Rebalance|Repartition", plan) for plan in written.values()), written


@pytest.mark.parametrize("threshold, line_exchanges", [("10m", 1), ("-1", 2)])
def test_line_items_cross_the_network_with_few_columns(spark, threshold, line_exchanges):
    """Line items are dealt out once for their orders, whatever the size of either, and never sorted for them; a second
    time only where parts cannot be broadcast. None of what they carry is text."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    plan = _physical(fixtures._dims(own, SMOKE_DIR))
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_" in line]
    assert len(lines) == line_exchanges, plan
    assert len(re.findall(r"ShuffledHashJoin \[l_orderkey", plan)) == 1 and "Sort [l_orderkey" not in plan, plan
    for text in ("l_returnflag", "l_linestatus", "l_suppkey", "l_shipdate"):
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert not any(text in line for line in joins)
    assert "l_suppkey" not in fixtures._dims(own, SMOKE_DIR).columns


def test_rows_of_odd_tables(spark):
    """Null flags, null keys, repeated keys and lines without a partner."""
    root = tempfile.mkdtemp(prefix="spendlens-odd-")
    day = dt.datetime(1996, 5, 17)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    tables = {
        "lineitem": (line, [
            (1, 1, 13, 1, 2.0, 10.5, 0.1, "R", "O", day),
            (1, 1, 14, 2, 3.0, 20.25, 0.2, "A", "F", day),
            (2, 2, None, None, 4.0, 30.0, None, None, None, None),
            (None, 1, 1, 1, 5.0, 1.0, 0.0, "A", "O", day),
            (1, None, 1, 1, 5.0, 1.0, 0.0, "A", "O", day),
            (9, 1, 1, 1, 5.0, 1.0, 0.0, "A", "O", day),
        ]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 7, "F", 1.0, day, "2-HIGH"), (2, 8, None, 2.0, day, None), (2, 8, None, 2.0, day, None), (None, 7, "F", 1.0, day, "2-HIGH"), (3, None, "F", 1.0, day, "2-HIGH")]),
        "customer": ("c_custkey long, c_mktsegment string", [(7, "BUILDING"), (8, None), (None, "BUILDING")]),
        "part": ("p_partkey long, p_type string, p_size int", [(1, "SMALL", 50), (1, "PROMO", 7), (2, None, None), (None, "SMALL", 1)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    src = fixtures.derive(spark, root)
    quarter = dt.date(1996, 4, 1)
    got = Counter(tuple(r) for r in src.fact.select(C.APP, C.MARKET, "MVP_CAMPAIGN_TYPE", C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION, C.DATE, "EXPENSE_AMT", "USER_QTY").collect())
    assert got == Counter({
        ("SMALL", "XX", "Retargeting", None, "SKANFB", "P2", quarter, D("1.05"), D(2)): 1,
        ("PROMO", "IT", "Retargeting", None, "SKANFB", "P1", quarter, D("1.05"), D(2)): 1,
        ("SMALL", "XX", "New Installs", "MK", "SKANFB", "P2", quarter, D("4.05"), D(3)): 1,
        ("PROMO", "GO", "New Installs", "MK", "SKANFB", "P1", quarter, D("4.05"), D(3)): 1,
        (None, "GO", "New Installs", "OT", "UNITY", None, None, None, D(4)): 2,
    })
    assert sorted((r.ACCOUNT_ID, r[C.APP]) for r in src.installs.collect()) == [(7, "PROMO"), (7, "SMALL")]
    assert src.skan.count() == 0 and src.projections.count() == 5

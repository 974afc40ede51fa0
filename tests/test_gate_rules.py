"""Gate rules as rows of a table."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from spendlens.operators import quality as Q

D1, D2 = dt.date(2022, 1, 1), dt.date(2022, 2, 1)
SCHEMA = "APPLICATION_FAMILY_NAME string, MARKET_CD string, SOURCE string, CALENDAR_DT date, SPEND double, INSTALL long"


def failed(spark, old, new, rules):
    old = spark.createDataFrame([("A", "IT", "SKAN", *old)], SCHEMA)
    new = spark.createDataFrame([("A", "IT", "SKAN", *new)], SCHEMA)
    (r,) = Q.gate_by_rules(old, new, rules).collect()
    return list(r.FAILED_RULES)


@pytest.mark.parametrize(
    "comparison,tolerance,just,beyond",
    [("not_below", 5, 95, 94), ("not_above", 5, 105, 106), ("share_not_below", "0.1", 90, 89), ("share_not_above", "0.1", 110, 111)],
)
def test_boundaries_of_every_comparison(spark, comparison, tolerance, just, beyond):
    rules = [Q.GateRule("R", "TOTAL_INSTALL", comparison, Decimal(tolerance))]
    assert failed(spark, (D1, 1.0, 100), (D1, 1.0, just), rules) == []
    assert failed(spark, (D1, 1.0, 100), (D1, 1.0, beyond), rules) == ["R"]


def test_days_scope_and_nulls(spark):
    late = Q.GateRule("LATE", "LAST_INSTALL_DT", "not_below", Decimal(3))
    assert failed(spark, (D2, 1.0, 1), (D2 - dt.timedelta(days=3), 1.0, 1), [late]) == []
    assert failed(spark, (D2, 1.0, 1), (D2 - dt.timedelta(days=4), 1.0, 1), [late]) == ["LATE"]
    drop = lambda *scope: Q.GateRule("DROP", "TOTAL_SPEND", "not_below", Decimal(0), scope)
    for scope, fails in ((("A", None, None), True), (("A", "IT", "SKAN"), True), (("A", "GO", None), False), ((None, None, "x'y"), False)):
        assert failed(spark, (D1, 2.0, 1), (D1, 1.0, 1), [drop(*scope)]) == ["DROP"] * fails
    assert failed(spark, (D1, None, 1), (D1, 1.0, 1), [drop(None, None, None)]) == []
    assert failed(spark, (D1, 2.0, 2), (D1, 1.0, 1), []) == []


def test_all_failed_rules_are_named(spark):
    rules = (Q.DATE_RULE, Q.INSTALL_RULE, Q.SPEND_RULE)
    assert failed(spark, (D2, 2.0, 9), (D1, 1.0, 1), rules) == ["DATE_WENT_BACK", "INSTALLS_DROPPED", "SPEND_DROPPED"]
    old = spark.createDataFrame([("A", "IT", "SKAN", D2, 2.0, 9)], SCHEMA)
    new = spark.createDataFrame([("A", "IT", "SKAN", D1, 1.0, 9)], SCHEMA)
    with pytest.raises(Q.QualityGateError, match="DATE_WENT_BACK, SPEND_DROPPED: last"):
        Q.assert_no_regression(old, new, rules=rules)
    Q.assert_no_regression(old, new, rules=[Q.INSTALL_RULE])


def test_rules_come_from_a_table(spark):
    rules = (Q.DATE_RULE, Q.GateRule("GREW", "TOTAL_INSTALL", "share_not_above", Decimal("0.500000"), ("A", None, None)), Q.INSTALL_RULE)
    table = Q.rule_table(spark, rules)
    assert Q.rules_from_table(table.toDF(*[c.lower() for c in table.columns])) == rules
    with pytest.raises(ValueError, match="missing TOLERANCE"):
        Q.rules_from_table(table.drop("TOLERANCE"))
    with pytest.raises(ValueError, match="names"):
        Q.rules_from_table(table.union(table))
    for bad in (("X", "INSTALLS", "not_below"), ("X", "TOTAL_SPEND", "below"), ("X", "LAST_INSTALL_DT", "share_not_below"), ("X", "TOTAL_SPEND", "not_below", Decimal(-1))):
        with pytest.raises(ValueError):
            Q.GateRule(*bad)

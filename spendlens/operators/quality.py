"""X12: regression gate between the previous publication and the new result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rates import sql_col, sql_str
from ..session import Scratch
from .rollup import game_rollup

#: installs may shrink by at most this much per app, market and source between runs
INSTALL_TOLERANCE = 1
#: spend may shrink by this share: a publication holds 32-bit floats, whose rounding is below it
SPEND_TOLERANCE = "0.000001"
#: violations written out in the message; all of them are in the relation it names
SHOWN = 20


class QualityGateError(Exception):
    """Raised when the new result regresses against the previous publication.

    ``total`` counts all violations, ``path`` is the Parquet relation that holds every one of
    them, ``shown`` the first few by key.
    """

    def __init__(self, total: int, shown: list[Row], path: str):
        self.total, self.shown, self.path = total, shown, path
        head = f"{total} game(s) regressed; all are in {path}. First {len(shown)} of {total}:"
        super().__init__("\n".join([head, *map(self._line, shown)]))

    @staticmethod
    def _line(r: Row) -> str:
        change = ", ".join(
            f"{name.lower().replace('_', ' ')} {r['OLD_' + name]} -> {r['NEW_' + name]}"
            for name in ("LAST_INSTALL_DT", "TOTAL_INSTALL", "TOTAL_SPEND")
        )
        return f"  [{' / '.join(str(r[k]) for k in C.KG)}] {', '.join(r.FAILED_RULES)}: {change}"


MEASURES = ("LAST_INSTALL_DT", "TOTAL_SPEND", "TOTAL_INSTALL")
#: how a rule compares the new measure (n) with the old one (o) and its tolerance (t): SQL that is true where it fails
COMPARISONS = {
    "not_below": "{n} < {o} - {t}",
    "not_above": "{n} > {o} + {t}",
    "share_not_below": "{n} < {o} * (1 - {t})",
    "share_not_above": "{n} > {o} * (1 + {t})",
}
RULE_SCHEMA = (
    f"RULE string, MEASURE string, COMPARISON string, TOLERANCE decimal(18,6), {C.APP} string, {C.MARKET} string, {C.SOURCE} string"
)
#: rules of one gate: they are compiled into one expression on the driver
MOST_RULES = 1_000


@dataclass(frozen=True)
class GateRule:
    """One row of a rule table. ``scope`` names the application, market and source the rule holds for (None: any)."""

    name: str
    measure: str
    comparison: str
    tolerance: Decimal = Decimal(0)
    scope: tuple[str | None, str | None, str | None] = (None, None, None)

    def __post_init__(self) -> None:
        if self.measure not in MEASURES or self.comparison not in COMPARISONS:
            raise ValueError(f"rule {self.name}: unknown measure {self.measure!r} or comparison {self.comparison!r}")
        if self.measure == "LAST_INSTALL_DT" and (self.comparison.startswith("share") or self.tolerance != int(self.tolerance)):
            raise ValueError(f"rule {self.name}: dates are compared by whole days")
        if self.tolerance < 0:
            raise ValueError(f"rule {self.name}: a tolerance is not negative")

    def fails(self) -> str:
        """SQL over the game's OLD_ and NEW_ measures: whether the rule applies and fails (a NULL measure does not)."""
        t = str(int(self.tolerance)) if self.measure == "LAST_INSTALL_DT" else f"{self.tolerance:f}"
        test = COMPARISONS[self.comparison].format(n=f"NEW_{self.measure}", o=f"OLD_{self.measure}", t=t)
        scope = [f"{sql_col(k)} = {sql_str(v)}" for k, v in zip(C.KG, self.scope) if v is not None]
        return " AND ".join([*scope, f"coalesce({test}, false)"])


#: the rules of the published job, and the spend rule its documentation promises
DATE_RULE = GateRule("DATE_WENT_BACK", "LAST_INSTALL_DT", "not_below")
INSTALL_RULE = GateRule("INSTALLS_DROPPED", "TOTAL_INSTALL", "not_below", Decimal(INSTALL_TOLERANCE))
SPEND_RULE = GateRule("SPEND_DROPPED", "TOTAL_SPEND", "share_not_below", Decimal(SPEND_TOLERANCE))
DEFAULT_RULES = (DATE_RULE, INSTALL_RULE)


def rules_from_table(table: DataFrame) -> tuple[GateRule, ...]:
    """The rules of a table (``RULE_SCHEMA``; NULL in a scope column: any), in order of their names."""
    spelled = {c.upper(): c for c in table.columns}
    wanted = [w.split() for w in RULE_SCHEMA.split(", ")]
    missing = [n for n, _ in wanted if n not in spelled]
    if missing:
        raise ValueError(f"gate rules: missing {', '.join(missing)}")
    rows = table.selectExpr(*[f"CAST({sql_col(spelled[n])} AS {kind}) AS {n}" for n, kind in wanted]).limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} gate rules")
    rules = [GateRule(r.RULE, r.MEASURE, r.COMPARISON, r.TOLERANCE or Decimal(0), tuple(r[k] for k in C.KG)) for r in rows]
    names = [r.name for r in rules]
    if None in names or len(set(names)) < len(names):
        raise ValueError("gate rules need names of their own")
    return tuple(sorted(rules, key=lambda r: r.name))


def rule_table(spark: SparkSession, rules: Sequence[GateRule]) -> DataFrame:
    """The rows of some rules, as a table that ``rules_from_table`` reads."""
    return spark.createDataFrame([(r.name, r.measure, r.comparison, r.tolerance, *r.scope) for r in rules], RULE_SCHEMA)


def failed_rules(rules: Sequence[GateRule]) -> Column:
    """Names of the rules a game fails, as one array expression."""
    return F.expr(f"array_compact(array({', '.join(f'CASE WHEN {r.fails()} THEN {sql_str(r.name)} END' for r in rules)}))")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    g = game_rollup(df)
    return g.select(*C.KG, *[F.col(c).alias(prefix + c) for c in MEASURES])


def compared_games(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every game (app, market, source) present on both sides with its old and new figures. Both sides are aggregated
    to game grain before the join, so only a few rows per game meet in it."""
    o, n = _prefixed(old, "OLD_").alias("o"), _prefixed(new, "NEW_").alias("n")
    same = " AND ".join(f"o.{k} <=> n.{k}" for k in C.KG)
    return o.join(n, F.expr(same)).select(*[f"o.{k}" for k in C.KG], *[f"o.OLD_{m}" for m in MEASURES], *[f"n.NEW_{m}" for m in MEASURES])


def gate_by_rules(old: DataFrame, new: DataFrame, rules: Sequence[GateRule] = DEFAULT_RULES) -> DataFrame:
    """``compared_games`` with FAILED_RULES, the names of the rules each fails."""
    return compared_games(old, new).withColumn("FAILED_RULES", failed_rules(rules) if rules else F.array().cast("array<string>"))


def gate_outcome(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every game present on both sides with its old and new figures, and whether its last install date went
    back, its installs dropped by more than the tolerance, and its spend by more than its own."""
    rules = (DATE_RULE, INSTALL_RULE, SPEND_RULE)
    return compared_games(old, new).select("*", *[F.expr(r.fails()).alias(r.name) for r in rules])


def regression_violations(
    old: DataFrame, new: DataFrame, check_spend: bool = False, rules: Sequence[GateRule] | None = None
) -> DataFrame:
    """The games that fail a rule: the published job's, its spend rule too if ``check_spend``, or ``rules``."""
    if rules is None:
        rules = (*DEFAULT_RULES, SPEND_RULE) if check_spend else DEFAULT_RULES
    return gate_by_rules(old, new, rules).where(F.size("FAILED_RULES") > 0)


def assert_no_regression(
    old: DataFrame | None, new: DataFrame, check_spend: bool = False, rules: Sequence[GateRule] | None = None
) -> None:
    """Raise QualityGateError if anything regressed; pass on a first run.

    The violations are written to shared storage and stay there when the gate fails."""
    if old is None:
        return
    scratch = Scratch(new.sparkSession)
    found = scratch.write(regression_violations(old, new, check_spend, rules), "violations")
    total = found.count()
    if total:
        shown = found.orderBy(*C.KG).limit(SHOWN).collect()
        raise QualityGateError(total, shown, scratch.path("violations"))
    scratch.release()

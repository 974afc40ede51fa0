"""Keyed verification of what a sink holds: digests that do not depend on the order of rows.

A digest of a group is the sum of a hash of each of its rows, so it is one partial aggregate and one small
shuffle however large the output is. A value that moved to another key, a key that changed or a row that is
missing or doubled changes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.rates import sql_col

#: mismatching groups written out in the message
SHOWN = 20
#: fractional numbers enter the portable digest in this many parts of one
PARTS = 1024


class SinkMismatch(Exception):
    """Raised when an output does not hold the rows of the plan that was written to it."""

    def __init__(self, output: str, total: int, shown: list[Row]):
        self.output, self.total, self.shown = output, total, shown
        lines = [f"  {r.asDict()}" for r in shown]
        super().__init__("\n".join([f"{output}: {total} group(s) differ from what was written", *lines]))


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of the exact values."""
    return F.xxhash64(*[F.col(sql_col(c)) for c in columns]).cast("decimal(38,0)")


def portable_text(f: T.StructField) -> str:
    """SQL of a value's text that any engine can build: fractions in whole 1024ths, NULL as ``\\N``."""
    c = sql_col(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        c = f"CAST(floor(CAST({c} AS DOUBLE) * {PARTS}) AS BIGINT)"
    return f"coalesce(CAST({c} AS STRING), '\\\\N')"


def portable_hash(fields: Sequence[T.StructField]) -> Column:
    """The first 60 bits of the MD5 of a row's texts, joined by ``|`` in the order of names."""
    texts = ", ".join(portable_text(f) for f in sorted(fields, key=lambda f: f.name))
    return F.expr(f"CAST(conv(substr(md5(concat_ws('|', {texts})), 1, 15), 16, 10) AS DECIMAL(38,0))")


def digests(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (C.APP,), portable: bool = False) -> DataFrame:
    """Per group of ``by``: ROW_COUNT, KEY_DIGEST (of the key columns) and ROW_DIGEST (of all columns, by name)."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    own = [f for f in fields if f.name in keys]
    hashed = portable_hash if portable else lambda some: row_hash([f.name for f in some])
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("ROW_COUNT"),
        F.sum(hashed(own)).alias("KEY_DIGEST"),
        F.sum(hashed(fields)).alias("ROW_DIGEST"),
    )


def known_digests(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (C.APP,)) -> DataFrame:
    """``digests`` computed now, to compare several sinks with (one row a group: an application, by default)."""
    found = digests(df, keys, by)
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def differing(expected: DataFrame, written: DataFrame, by: Sequence[str] = (C.APP,)) -> DataFrame:
    """Groups whose digests differ between two relations of ``digests``, or that only one has."""
    names = ("ROW_COUNT", "KEY_DIGEST", "ROW_DIGEST")
    same_group = " AND ".join(f"a.{sql_col(k)} <=> b.{sql_col(k)}" for k in by)
    same = " AND ".join(f"a.{n} <=> b.{n}" for n in names)
    return expected.alias("a").join(written.alias("b"), F.expr(same_group), "full").where(f"NOT ({same})").selectExpr(
        *[f"coalesce(a.{sql_col(k)}, b.{sql_col(k)}) AS {sql_col(k)}" for k in by],
        *[f"{side}.{n} AS {name}_{n}" for side, name in (("a", "PLAN"), ("b", "SINK")) for n in names],
    )


def assert_written(
    output: str,
    plan: DataFrame,
    written: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = (C.APP,),
    expected: DataFrame | None = None,
) -> None:
    """Raise SinkMismatch unless ``written`` has the rows of ``plan``, types included. ``expected``: the plan's
    ``known_digests``, where several sinks are compared with it."""
    types = {f.name: f.dataType for f in plan.schema.fields}
    found = {f.name: f.dataType for f in written.schema.fields}
    if types != found:
        raise ValueError(f"{output} has columns {found}, not {types}")
    expected = digests(plan, keys, by) if expected is None else expected
    wrong = differing(expected, digests(written.select(plan.columns), keys, by), by)
    shown = wrong.orderBy(*by).limit(SHOWN).collect()
    if shown:
        raise SinkMismatch(output, wrong.count(), shown)

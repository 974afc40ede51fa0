"""Column helpers shared by the operators: decimal normalisation, clamping, metric sums.

Wide projections are written as SQL expression text (``selectExpr`` / ``F.expr``): one
JVM call per expression instead of one per Column node, and the same Catalyst plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import require_ansi
from .rates import sql_col

METRIC_DECIMAL_SQL = f"DECIMAL({C.METRIC_DECIMAL.precision},{C.METRIC_DECIMAL.scale})"


def _needs_rebase(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.DecimalType) and dtype != C.METRIC_DECIMAL


def normalize_decimals(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast decimal metric columns back to ``METRIC_DECIMAL``.

    Spark widens precision on every sum and difference and, past 38 digits, silently drops
    scale digits. Re-basing after each roll-up keeps every value exact: a metric has at most
    ``MAX_INPUT_SCALE`` digits of scale from its input and three from a share rate. A finer
    column is refused, and so is a session in which an overflowing cast would be NULL. Other
    columns (double or long inputs) are left alone.
    """
    require_ansi(df.sparkSession)
    wanted = set(columns)
    fields = df.schema.fields
    for f in fields:
        if f.name in wanted and isinstance(f.dataType, T.DecimalType) and f.dataType.scale > C.METRIC_DECIMAL.scale:
            raise ValueError(f"{f.name} has scale {f.dataType.scale}: inputs may have {C.MAX_INPUT_SCALE} digits of scale")
    if not any(f.name in wanted and _needs_rebase(f.dataType) for f in fields):
        return df
    exprs = [
        f"CAST({sql_col(f.name)} AS {METRIC_DECIMAL_SQL}) AS {sql_col(f.name)}"
        if f.name in wanted and _needs_rebase(f.dataType)
        else sql_col(f.name)
        for f in fields
    ]
    return df.selectExpr(*exprs)


def zero_metric() -> Column:
    return F.lit(0).cast(C.METRIC_DECIMAL)


def clamp_sql(metric: str, alias: str | None = None) -> str:
    """Negative and NULL become 0; NaN and non-negative values pass."""
    m = sql_col(metric)
    return f"CASE WHEN {m} >= 0 THEN {m} ELSE 0 END AS {sql_col(alias or metric)}"


def clamp_nonnegative(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Clamp every listed metric in one projection, keeping the column order."""
    wanted = set(metrics)
    return df.selectExpr(*[clamp_sql(c) if c in wanted else sql_col(c) for c in df.columns])


def sum_metrics(metrics: Sequence[str], prefix: str = "") -> list[Column]:
    """``sum(m) AS prefix+m`` for each metric."""
    return [F.expr(f"sum({sql_col(m)}) AS {sql_col(prefix + m)}") for m in metrics]


def renamed_sums(columns: Sequence[str], names: Sequence[str]) -> list[Column]:
    """``sum(column) AS name`` for each pair."""
    return [F.expr(f"sum({sql_col(c)}) AS {sql_col(n)}") for c, n in zip(columns, names)]

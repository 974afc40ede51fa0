"""Latest snapshot per key, with or without ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rates import sql_col


TIES = ("keep", "one")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str, ties: str = "keep", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Rows whose ``order_col`` equals the maximum of their key group: all tied rows (``ties="keep"``), or
    one row per key (``ties="one"``).

    Rows with a NULL key or a NULL ``order_col`` never qualify (equi-join semantics).

    Of tied rows the one with the largest ``tie_break`` columns, then the largest other columns in their order, stays
    (NULL is smallest), so the result does not depend on the order of rows. That is an ordered struct maximum:
    partially aggregated, one row per key and map task, no window and no join.

    Plan: a partially aggregated ``max`` per key (map-side combine, so a hot key costs one
    row per map task), then a left-semi join on ``keys + order_col``. The semi join hashes
    on the date too, so one key with a long history spreads over many partitions, and AQE's
    skew-join split applies to the semi join's left side if one (key, date) is still hot.
    No window: a window would sort each key group inside a single task.
    """
    keys = list(keys)
    not_null = F.col(order_col).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    valid = df.where(not_null)
    if ties not in TIES:
        raise ValueError(f"unknown ties policy {ties!r}")
    if ties == "one":
        ordered = [order_col, *tie_break]
        ordered += [c for c in df.columns if c not in (*keys, *ordered)]
        best = valid.groupBy(*keys).agg(F.max(F.struct(*[sql_col(c) for c in ordered])).alias("_best"))
        return best.select(*[c if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])
    if tie_break:
        raise ValueError("tie_break is for one row per key")
    maxima = valid.groupBy(*keys).agg(F.max(order_col).alias(order_col))
    return valid.join(maxima, on=[*keys, order_col], how="left_semi")

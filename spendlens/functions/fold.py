"""Channel / promotion fold: unpaid traffic becomes ORGANIC, SKAN channel names get aliased."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def alias_channel(channel: Column, alias: Sequence[tuple[str, str]]) -> Column:
    """Rename channels by a small fixed map; others (and NULL) pass through."""
    expr = None
    for raw, name in alias:
        cond = channel == F.lit(raw)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return channel if expr is None else expr.otherwise(channel)


def is_paid(source_type: Column, paid_types: Sequence[str]) -> Column:
    return source_type.isin(list(paid_types))


def fold_organic(
    df: DataFrame,
    paid_types: Sequence[str] = C.PAID_SOURCE_TYPES,
    channel_alias: Sequence[tuple[str, str]] | None = C.CHANNEL_ALIAS,
) -> DataFrame:
    """Replace CHANNEL_NAME and PROMOTION_NAME with ORGANIC unless the source type is paid.

    A NULL source type is unpaid (``NULL IN (...)`` is not true) but the column itself keeps
    its NULL, so the folded row stays distinct from explicit organic types.
    """
    paid = is_paid(F.col(C.SOURCE_TYPE), paid_types)
    channel = F.col(C.CHANNEL)
    if channel_alias:
        channel = alias_channel(channel, channel_alias)
    organic = F.lit(C.ORGANIC)
    return df.withColumns(
        {
            C.CHANNEL: F.when(paid, channel).otherwise(organic),
            C.PROMOTION: F.when(paid, F.col(C.PROMOTION)).otherwise(organic),
        }
    )

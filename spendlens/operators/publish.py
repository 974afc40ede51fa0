"""X13 published schema and X14 publication (dated Parquet snapshot + catalog table)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.rates import sql_str
from ..session import delete_path
from .verify import assert_written, known_digests


#: type of money and of counts under each cast policy
CASTS = {"legacy": ("float", "int"), "reject": ("float", "int"), "clean": (C.METRIC_DECIMAL, C.METRIC_DECIMAL)}
REJECTED = "REJECTED_METRICS"


def to_published(df: DataFrame, policy: str = "legacy") -> DataFrame:
    """Cast metrics to the published types in one projection.

    ``legacy``: money as 32-bit float, counts as 32-bit int (truncating; under ANSI mode an
    out-of-range count fails the job instead of wrapping). ``clean``: exact decimals. ``reject``: the
    types of ``legacy``, without the rows that do not fit them; ``rejected_rows`` has those.
    """
    money, count = _types(df, policy)
    casts = {m: F.col(m).cast(money) for m in C.MONEY_METRICS}
    casts.update({m: F.col(m).cast(count) for m in C.COUNT_METRICS})
    return (df.where(F.size(_misfits(money, count)) == 0) if policy == "reject" else df).withColumns(casts)


def rejected_rows(df: DataFrame, policy: str = "reject") -> DataFrame:
    """The rows of which a metric does not fit its published type, as they were, with the names of
    those metrics in ``REJECTED_METRICS``. NULL fits; a finite number must stay finite."""
    money, count = _types(df, policy)
    return df.withColumn(REJECTED, _misfits(money, count)).where(F.size(REJECTED) > 0)


def _types(df: DataFrame, policy: str):
    if policy not in CASTS:
        raise ValueError(f"unknown policy {policy!r}")
    missing = [m for m in C.METRICS if m not in df.columns]
    if missing:
        raise ValueError(f"not a complete table: {', '.join(missing)} missing")
    return CASTS[policy]


def _misfits(money, count) -> Column:
    """Names of a row's metrics that a cast would turn into NULL or infinity."""

    def misfit(m: str, dtype) -> Column:
        value = F.col(m).try_cast(dtype)
        lost = value.isNull()
        if dtype == "float":
            lost = lost | F.isnan(value) | (F.abs(value) == float("inf"))
        return F.when(F.col(m).isNotNull() & lost, F.lit(m))

    tests = [misfit(m, money if m in C.MONEY_METRICS else count) for m in C.METRICS]
    return F.array_compact(F.array(*tests))


@dataclass(frozen=True)
class PublishTarget:
    """Where one output goes: a dated snapshot directory and a catalog table."""

    table: str
    snapshot_path: str
    #: external table location; None writes a managed table into the warehouse
    table_path: str | None = None
    format: str = "parquet"


def balanced(df: DataFrame) -> DataFrame:
    # REBALANCE lets AQE split an oversized application partition and merge small ones, so
    # files stay near the advisory size without one task writing a hot application alone.
    return df.hint("rebalance", C.APP)


def write_snapshot(df: DataFrame, path: str, only: Sequence[str] | None = None) -> None:
    """Write the dated snapshot; with ``only``, replace the folders of those applications alone.

    Rows of other applications are not written then, and one of ``only`` without rows loses its folder."""
    if only is None:
        balanced(df).write.mode("overwrite").partitionBy(C.APP).parquet(path)
        return
    own = df.where(F.col(C.APP).isin(list(only)))
    # dynamic overwrite replaces the folders it has rows for, once all of them are written
    balanced(own).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(C.APP).parquet(path)
    for app in _without_rows(own, only):
        delete_path(df.sparkSession, f"{path}/{_folder(df.sparkSession, app)}")


def write_table(spark: SparkSession, path: str, target: PublishTarget, only: Sequence[str] | None = None) -> None:
    """Replace the catalog table from the snapshot files just written (no recomputation,
    and the written plan never reads the table it overwrites); with ``only``, its partitions of those
    applications alone."""
    snap = _snapshot(spark, path)
    if only is None or not spark.catalog.tableExists(target.table):
        w = snap.write.mode("overwrite").format(target.format).partitionBy(C.APP)
        if target.table_path is not None:
            w = w.option("path", target.table_path)
        w.saveAsTable(target.table)
        return
    own = snap.where(F.col(C.APP).isin(list(only)))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert takes it from the session
    try:
        own.select(spark.table(target.table).columns).write.insertInto(target.table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    for app in _without_rows(own, only):
        spark.sql(f"ALTER TABLE {target.table} DROP IF EXISTS PARTITION ({C.APP} = {sql_str(app)})")
    spark.catalog.refreshTable(target.table)


def _snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot as written: an application whose name looks like a number is still a name."""
    snap = spark.read.parquet(path)
    return snap.withColumn(C.APP, F.col(C.APP).cast("string"))


def _without_rows(df: DataFrame, only: Sequence[str]) -> list[str]:
    found = {r[0] for r in df.select(C.APP).distinct().collect()}  # of the applications named
    return sorted(set(only) - found)


def _folder(spark: SparkSession, app: str) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{C.APP}={escape(app)}"


def publish(
    spark: SparkSession,
    campaign: DataFrame,
    channel: DataFrame,
    campaign_target: PublishTarget,
    channel_target: PublishTarget,
    policy: str = "legacy",
    only: Sequence[str] | None = None,
    verify: bool = True,
) -> None:
    """Snapshots first, tables last, each verified against the plan when written.

    With ``only``, partitions of those applications are replaced and others left as they are, in all four
    outputs; a snapshot path without data then starts with them alone.

    A failure while the snapshots are written leaves both tables at the previous run. The two
    tables are not replaced together (``Publication`` does that): if the second ``saveAsTable`` fails,
    the campaign table is new and the channel table is the previous one, or absent if it failed halfway (an
    overwrite drops first). Both dated snapshots are complete by then, so running ``write_table`` again
    from them mends it without computing anything.
    """
    outputs = []
    for name, df, target, keys in (
        ("campaign", campaign, campaign_target, C.CAMPAIGN_KEYS),
        ("channel", channel, channel_target, C.KCH),
    ):
        plan = to_published(df, policy)
        if only is not None:
            plan = plan.where(F.col(C.APP).isin(list(only)))
        keys = [k for k in keys if k in plan.columns]
        outputs.append((name, plan, target, keys, known_digests(plan, keys) if verify else None))

    def verified(what: str, plan: DataFrame, written: DataFrame, keys: Sequence[str], expected: DataFrame | None) -> None:
        if verify:
            own = written if only is None else written.where(F.col(C.APP).isin(list(only)))
            assert_written(what, plan, own, keys, expected=expected)

    for name, plan, target, keys, expected in outputs:
        write_snapshot(plan, target.snapshot_path, only)
        verified(f"{name} snapshot", plan, _snapshot(spark, target.snapshot_path), keys, expected)
    for name, plan, target, keys, expected in outputs:
        part = {} if only is None else {"only": only}
        write_table(spark, target.snapshot_path, target, **part)
        verified(f"{name} table", plan, spark.table(target.table), keys, expected)

"""Co-partitioned inputs: the user-level inputs as tables bucketed on the user key.

The install roll-up aggregates the projection history per user and joins it with installs per user. On tables
that are bucketed on the user key both sides are already where they meet, so the exchanges of the history (twice)
and of the installs go: what is left is the exchange of the joined sums to campaign grain. Worth its
writing where several runs read one day's inputs, or a loader can write them so.

Installs are written counted (``INSTALLS`` per user key, campaign columns and day): a bucket is read by one task, and a sentinel
user that holds a third of all installs must not make that task read them one by one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.rollup import INSTALLS
from .catalog import INSTALL_COLUMNS, PROJECTION_COLUMNS, Sources

#: buckets of each table: a multiple of the executors' cores; some 200 MB a bucket and file at most
BUCKETS = 32


def write_bucketed(df: DataFrame, table: str, buckets: int = BUCKETS, location: str | None = None) -> DataFrame:
    """Write ``df`` as a catalog table bucketed and sorted on the user key, and read it back.

    A rebalance on the key keeps files few (a task has whole buckets) and lets Spark split a hot one."""
    w = df.hint("rebalance", *C.USER_KEY).write.mode("overwrite").format("parquet")
    if location is not None:
        w = w.option("path", location)
    w.bucketBy(buckets, *C.USER_KEY).sortBy(*C.USER_KEY).saveAsTable(table)
    return df.sparkSession.table(table)


def counted_installs(installs: DataFrame) -> DataFrame:
    """Equal installs as one row with their count; columns the job does not know are dropped, unless a campaign type."""
    known = [c for c in installs.columns if c.upper() in (*INSTALL_COLUMNS, "MVP_CAMPAIGN_TYPE")]
    return installs.groupBy(*known).agg(F.count(F.lit(1)).alias(INSTALLS))


def bucketed_sources(
    sources: Sources, installs_table: str, projections_table: str, buckets: int = BUCKETS, location: str | None = None
) -> Sources:
    """``sources`` with installs and the projection history read from bucketed tables, which are written here."""
    place = (lambda name: f"{location.rstrip('/')}/{name}") if location else lambda name: None
    return replace(
        sources,
        installs=write_bucketed(counted_installs(sources.installs), installs_table, buckets, place("installs")),
        projections=write_bucketed(sources.projections.select(*PROJECTION_COLUMNS), projections_table, buckets, place("projections")),
    )

"""Input relations of one run, read from catalog tables (production) or built by fixtures.

Operators take DataFrames, never table names, so tests can hand in temp views or derived
fixtures. Reading is lazy: filters and projections applied later reach the Parquet/Delta
scan through Catalyst (partition pruning on the date column, pushed filters, column pruning).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C


@dataclass(frozen=True)
class TableNames:
    """Catalog names of the inputs and outputs (deployment configuration, no defaults)."""

    fact: str
    projections: str
    installs: str
    skan: str
    campaign_table: str
    channel_table: str


FACT_COLUMNS = (
    C.APP, C.MARKET, "MVP_CAMPAIGN_TYPE", C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION, C.DATE, "EXPENSE_AMT", "USER_QTY",
    *C.RETENTION_METRICS,
    *(f"{kind}_DAY_{d:03d}_AMT" for d in C.REVENUE_DAYS for kind in ("REVS", "AD_REVS", "SUBSCRIPTIONS_REVS")),
    "LTV_365_LASTEST_VAL", "AD_LTV_365_LASTEST_VAL",
)
INSTALL_COLUMNS = (C.APP, C.MARKET, C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION, "INSTALL_DT", *C.USER_KEY)
PROJECTION_COLUMNS = (*C.USER_KEY, "PROJECTION_DT", "SUB_PROJECTEDREVENUE_365")
SKAN_COLUMNS = (
    C.APP, C.CHANNEL, "PROMOTION_CD", "INSTALL_DT", "INSTALL_NUM", "GROSS_IAP_LTV_365_LATEST_VAL",
    "NET_OVERALL_LTV_365_LATEST_VAL",
)
PREVIOUS_COLUMNS = (C.APP, C.MARKET, C.SOURCE, C.DATE, "SPEND", C.INSTALL)
DATE_COLUMNS = (C.DATE, "INSTALL_DT", "PROJECTION_DT")


def conformed(df: DataFrame, columns: tuple[str, ...], what: str) -> DataFrame:
    """``df`` with the job's columns under the job's spelling, and its days as dates.

    Names match whatever their case; a missing one is an error, as are two that differ in case
    only. A timestamp counts as its day, so the last day of a window is whole. Columns the job
    does not know stay.
    """
    spelled: dict[str, list[str]] = {}
    for name in df.columns:
        spelled.setdefault(name.upper(), []).append(name)
    missing = [c for c in columns if c not in spelled]
    twice = [c for c in columns if len(spelled.get(c, ())) > 1]
    if missing or twice:
        raise ValueError(f"{what}: " + "; ".join(f"{k} {', '.join(v)}" for k, v in (("missing", missing), ("ambiguous", twice)) if v))

    def column(f: T.StructField) -> Column:
        c, upper = F.col(f"`{f.name}`"), f.name.upper()
        if upper not in columns:
            return c
        if upper in DATE_COLUMNS and not isinstance(f.dataType, T.DateType):
            c = c.cast("date")
        return c.alias(upper)

    return df.select(*map(column, df.schema.fields))


@dataclass
class Sources:
    """The four inputs and, optionally, the previous publication, all ``conformed``."""

    fact: DataFrame
    installs: DataFrame
    projections: DataFrame
    skan: DataFrame
    previous: DataFrame | None = None

    def __post_init__(self) -> None:
        self.fact = conformed(self.fact, FACT_COLUMNS, "fact")
        self.installs = conformed(self.installs, INSTALL_COLUMNS, "installs")
        self.projections = conformed(self.projections, PROJECTION_COLUMNS, "projections")
        self.skan = conformed(self.skan, SKAN_COLUMNS, "skan")
        if self.previous is not None:
            self.previous = conformed(self.previous, PREVIOUS_COLUMNS, "previous publication")

    @classmethod
    def from_tables(cls, spark: SparkSession, names: TableNames) -> Sources:
        return cls(
            fact=spark.table(names.fact),
            installs=spark.table(names.installs),
            projections=spark.table(names.projections),
            skan=spark.table(names.skan),
            previous=read_previous(spark, names.campaign_table),
        )


def read_previous(spark: SparkSession, table: str) -> DataFrame | None:
    """The last published campaign table, or None on a first run (nothing to compare)."""
    if not spark.catalog.tableExists(table):
        return None
    return spark.table(table)

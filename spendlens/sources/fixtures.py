"""Test inputs derived from the driver's TPC-H-style tables (see FIXTURES.md).

The attribution job reads four catalog tables that ship with no sample data. These
adapters derive equivalent relations from ``lineitem``, ``orders``, ``customer`` and
``part`` with plain DataFrame expressions, so every query's work grows with the scale
factor. Every monetary value is an exact decimal (no floating-point arithmetic), which is
what makes results comparable value-for-value with an independent SQL engine.
"""

from __future__ import annotations

import datetime as dt
import weakref
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.fold import alias_channel
from ..session import Scratch, hadoop_path
from .catalog import Sources

# Fixture run parameters.
FIXTURE_APPS = ("ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM")
FIXTURE_TIERS = C.RoyaltyTiers(tier_a="ECONOMY", tier_b="PROMO", tier_c="SMALL")
FIXTURE_WINDOW = C.ReportWindow(start=dt.date(1995, 4, 1), as_of=dt.date(2001, 7, 2), delay_days=3)
FIXTURE_GOOGLE_REDUCED_FEE_FROM = dt.date(1998, 1, 1)

# Fixture measures: decimal multiples of quantity, one per gross revenue column, so that no
# two columns are equal and cumulative revenue grows with the day horizon.
REVENUE_MULTIPLIERS = {
    "REVS": ("0.50", "0.90", "1.40", "1.90", "2.60"),
    "AD_REVS": ("0.20", "0.35", "0.55", "0.80", "1.10"),
    "SUBSCRIPTIONS_REVS": ("0.10", "0.25", "0.45", "0.70", "0.95"),
}
RETENTION_MULTIPLIERS = ("0.60", "0.40", "0.25")

MONEY = T.DecimalType(18, 2)


def fixture_config(window: C.ReportWindow = FIXTURE_WINDOW) -> C.JobConfig:
    return C.JobConfig(
        apps=FIXTURE_APPS,
        window=window,
        tiers=FIXTURE_TIERS,
        google_reduced_fee_from=FIXTURE_GOOGLE_REDUCED_FEE_FROM,
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_place(sf_dir, name))


def _place(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _quarter(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "quarter")


def _times(base: Column, multiplier: str, dtype: T.DecimalType) -> Column:
    return (base * F.lit(Decimal(multiplier))).cast(dtype)


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to order, customer and part, with the shared campaign dimensions.

    Orders meet their customers before the lines do, and lines come to the joins with their flags instead of
    the columns these are read from. Line items cross the network once for their orders, whatever the size of either,
    and a second time only where parts are too many to be broadcast; they are never sorted for the orders.
    """
    line = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        (F.col("l_suppkey") % 10 == 3).alias("NO_SOURCE_TYPE"),
        (F.col("l_linestatus") == "O").alias("IOS_LINE"),
        (F.col("l_returnflag") == "R").alias("RETARGETED"),
        (F.col("l_linenumber") == 1).alias("FIRST_LINE"),
        _quarter(F.col("l_shipdate")).alias("EVENT_DT"),
    )
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = (
        _table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    joined = (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .drop("l_partkey", "p_partkey")
        .join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    priority = F.col("o_orderpriority")
    source_type = (
        F.when(F.col("NO_SOURCE_TYPE"), F.lit(None).cast("string"))
        .when(priority == "1-URGENT", "MM")
        .when(priority == "2-HIGH", "MK")
        .when(priority == "3-MEDIUM", "MC")
        .when(priority == "4-NOT SPECIFIED", "US")
        .otherwise("OT")
    )
    segment = F.col("c_mktsegment")
    channel = (
        F.when(segment == "AUTOMOBILE", "SKANUAC")
        .when(segment == "BUILDING", "SKANFB")
        .when(segment == "FURNITURE", "X_UNTRUSTED")
        .when(segment == "HOUSEHOLD", "ADWORDS")
        .otherwise("UNITY")
    )
    return joined.select(
        F.col("p_type").alias(C.APP),
        F.when(F.col("p_size") == 50, "XX")
        .when(F.col("IOS_LINE"), C.IOS_MARKET)
        .otherwise(C.GOOGLE_MARKET)
        .alias(C.MARKET),
        source_type.alias(C.SOURCE_TYPE),
        channel.alias(C.CHANNEL),
        F.concat(F.lit("P"), (F.col("p_size") % 3).cast("string")).alias(C.PROMOTION),
        F.col("EVENT_DT"),
        F.when(F.col("RETARGETED"), "Retargeting")
        .otherwise(C.CAMPAIGN_TYPE)
        .alias("MVP_CAMPAIGN_TYPE"),
        F.col("l_quantity").cast(T.DecimalType(18, 0)).alias("QTY"),
        F.col("l_extendedprice").cast(MONEY).alias("PRICE"),
        F.col("l_discount").cast(T.DecimalType(4, 2)).alias("DISCOUNT"),
        F.col("FIRST_LINE"),
        F.col("IOS_LINE"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
    )


def promo_fact(spark: SparkSession, sf_dir: str, dims: DataFrame | None = None) -> DataFrame:
    """Campaign expense fact: one row per line item."""
    d = dims if dims is not None else _dims(spark, sf_dir)
    qty, price = F.col("QTY"), F.col("PRICE")
    cols = [
        C.APP, C.MARKET, "MVP_CAMPAIGN_TYPE", C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION,
        F.col("EVENT_DT").alias(C.DATE),
        (price * F.col("DISCOUNT")).cast(T.DecimalType(18, 4)).alias("EXPENSE_AMT"),
        qty.cast(MONEY).alias("USER_QTY"),
    ]
    for day, m in zip(C.RETENTION_DAYS, RETENTION_MULTIPLIERS):
        cols.append(_times(qty, m, MONEY).alias(f"RETENTION_DAY_{day:03d}_QTY"))
    for i, day in enumerate(C.REVENUE_DAYS):
        for kind, mults in REVENUE_MULTIPLIERS.items():
            cols.append(_times(qty, mults[i], MONEY).alias(f"{kind}_DAY_{day:03d}_AMT"))
    cols += [
        price.alias("LTV_365_LASTEST_VAL"),
        _times(qty, "7.25", MONEY).alias("AD_LTV_365_LASTEST_VAL"),
    ]
    return d.select(*cols)


def installs(spark: SparkSession, sf_dir: str, dims: DataFrame | None = None) -> DataFrame:
    """Install records: the first line of each order is one install of its customer."""
    d = (dims if dims is not None else _dims(spark, sf_dir)).where(F.col("FIRST_LINE"))
    return d.select(
        C.APP, C.MARKET, C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION,
        F.col("EVENT_DT").alias("INSTALL_DT"),
        F.col("o_orderstatus").alias("APPLICATION_CD"),
        F.col("o_custkey").alias("ACCOUNT_ID"),
        (F.col("o_custkey") % 7).alias("USER_ID"),
    )


def projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection history: one row per order; several per user and quarter create ties."""
    o = _table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    total = F.col("o_totalprice").cast(MONEY)
    dec4 = T.DecimalType(18, 4)
    return o.select(
        F.col("o_custkey").alias("ACCOUNT_ID"),
        (F.col("o_custkey") % 7).alias("USER_ID"),
        F.col("o_orderstatus").alias("APPLICATION_CD"),
        _quarter(F.col("o_orderdate")).alias("PROJECTION_DT"),
        _times(total, "0.02", dec4).alias("IAP_PROJECTEDREVENUE_365"),
        _times(total, "0.03", dec4).alias("AD_PROJECTEDREVENUE_365"),
        _times(total, "0.01", dec4).alias("SUB_PROJECTEDREVENUE_365"),
    )


def skan_ltv(spark: SparkSession, sf_dir: str, dims: DataFrame | None = None) -> DataFrame:
    """SKAN postback LTV: iOS lines of source type MK of the networks that report through SKAN;
    channels arrive already aliased."""
    d = (dims if dims is not None else _dims(spark, sf_dir)).where(
        F.col(C.CHANNEL).isin([name for name, _ in C.CHANNEL_ALIAS])
        & F.col("IOS_LINE")
        & (F.col(C.SOURCE_TYPE) == C.RESIDUAL_PAID_TYPE)
    )
    channel = alias_channel(F.col(C.CHANNEL), C.CHANNEL_ALIAS)
    qty, price = F.col("QTY"), F.col("PRICE")
    return d.select(
        C.APP,
        channel.alias(C.CHANNEL),
        F.col(C.PROMOTION).alias("PROMOTION_CD"),
        F.col("EVENT_DT").alias("INSTALL_DT"),
        _times(qty, "0.80", MONEY).alias("INSTALL_NUM"),
        _times(price, "0.9", T.DecimalType(18, 3)).alias("GROSS_IAP_LTV_365_LATEST_VAL"),
        _times(price, "0.75", T.DecimalType(18, 4)).alias("NET_OVERALL_LTV_365_LATEST_VAL"),
    )


def derive(spark: SparkSession, sf_dir: str, dims: DataFrame | None = None) -> Sources:
    """The four fixture inputs as lazy derivations of the TPC-H-style tables (``dims``: the
    line/order/customer/part join, when already computed)."""
    return Sources(
        fact=promo_fact(spark, sf_dir, dims),
        installs=installs(spark, sf_dir, dims),
        projections=projections(spark, sf_dir),
        skan=skan_ltv(spark, sf_dir, dims),
    )


#: what a session has staged, by version of the source files; it goes with the session
_STAGED: weakref.WeakKeyDictionary[SparkSession, dict[tuple, tuple[Scratch, object]]] = weakref.WeakKeyDictionary()
_SOURCE_TABLES = ("lineitem", "orders", "customer", "part")


def _version(spark: SparkSession, path: str) -> tuple:
    """The files of a path with their sizes and times, in whatever store they are."""
    fs, p = hadoop_path(spark, path)
    return tuple(sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))


def staged(spark: SparkSession, sf_dir: str, name: str, make: Callable[[Scratch], object]):
    """What ``make`` writes to a scratch folder, once a session for each version of the source files."""
    key = (name, sf_dir, tuple(_version(spark, _place(sf_dir, t)) for t in _SOURCE_TABLES))
    own = _STAGED.setdefault(spark, {})
    if key not in own:
        scratch = Scratch(spark)
        own[key] = (scratch, make(scratch))
    return own[key][1]


def release(spark: SparkSession) -> None:
    """Delete everything a session has staged; relations read from there can no longer be used."""
    for scratch, _ in _STAGED.pop(spark, {}).values():
        scratch.release()


def load(spark: SparkSession, sf_dir: str) -> Sources:
    """Fixture inputs for the queries.

    The derived relations are written as Parquet tables to the shared folder, once a session for
    each version of the source files, and read back: queries scan physical tables with pushed
    filters and pruned columns, as they would scan the catalog tables in production.
    """

    def make(scratch: Scratch) -> Sources:
        # The line/order/customer/part join feeds three fixtures: compute it once. Its last exchange
        # sizes the files already; nothing is dealt out again for the write.
        dims = scratch.write(_dims(spark, sf_dir), "dims")
        lazy = derive(spark, sf_dir, dims)
        return Sources(**{name: scratch.write(getattr(lazy, name), name) for name in ("fact", "installs", "projections", "skan")})

    return staged(spark, sf_dir, "inputs", make)

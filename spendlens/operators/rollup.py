"""Roll-ups: campaign fact (X1), install-level LTV (X5), SKAN postbacks (X7), channel (X10),
game (X11).

Each is one ``groupBy().agg()`` over generated built-in expressions: Spark plans a partial
(map-side) aggregate, one hash exchange on the grouping key and a final aggregate, so a hot
key (every unpaid row of an app and day folds into ORGANIC/ORGANIC) costs at most one
partial row per map task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.cards import CardBook
from ..functions.fold import fold_organic
from ..functions.metrics import normalize_decimals, renamed_sums, sum_metrics, zero_metric
from ..functions.rates import RateBook, sql_col, sql_str


def sum_of(sql: str, name: str):
    """``sum(<sql expression>) AS name``, parsed once on the JVM."""
    return F.expr(f"sum({sql}) AS {sql_col(name)}")


#: a group sum is narrowed to this precision before a share rate (at most 3 digits)
#: multiplies it, so the product fits in 38 digits with its full scale
RATED_SUM_PRECISION = 34


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    """Column types of ``df`` (resolved once, for many sums)."""
    return {f.name: f.dataType for f in df.schema.fields}


def group_sum(types: dict[str, T.DataType], column: str) -> str:
    """SQL for ``sum(column)``, ready to be multiplied by a share rate.

    Every share rate depends only on application, market and date, which are grouping keys
    wherever a rate is applied, so ``sum(x * rate) = rate * sum(x)`` exactly: the rate is
    applied once per group instead of once per row.
    """
    dtype = types[column]
    total = f"sum({sql_col(column)})"
    if isinstance(dtype, T.DecimalType):
        if dtype.scale > C.MAX_INPUT_SCALE:
            raise ValueError(f"{column} has scale {dtype.scale}: inputs may have {C.MAX_INPUT_SCALE} digits of scale")
        return f"CAST({total} AS DECIMAL({RATED_SUM_PRECISION},{dtype.scale}))"
    return total


def rated(sql: str, name: str):
    return F.expr(f"{sql} AS {sql_col(name)}")


def carded_sum(types: dict[str, T.DataType], column: str, name: str):
    """``sum(column) AS name``, to be multiplied by a share column (one digit more than a literal rate)."""
    sql = group_sum(types, column)
    if isinstance(types[column], T.DecimalType):
        sql = f"CAST(sum({sql_col(column)}) AS DECIMAL({RATED_SUM_PRECISION - 1},{types[column].scale}))"
    return rated(sql, name)


def netted(rollup: DataFrame, book: CardBook, nets: dict[str, tuple[str, str]]) -> DataFrame:
    """``rollup`` with each gross sum (net name -> kind, gross SQL) times its share of the book, under its net
    name. Subscriptions that are NULL, or that no card covers, are 0; IAP and ads keep NULL sums."""
    sums = {}
    for name, (kind, gross) in nets.items():
        product = f"{gross} * {book.share(kind)}"
        sums[name] = f"coalesce({product}, 0)" if kind.startswith("SUB") else product
    kept = [sql_col(c) for c in rollup.columns if c not in nets and not c.startswith("GROSS_")]
    return book.joined(rollup).selectExpr(*kept, *[f"{x} AS {sql_col(n)}" for n, x in sums.items()])


def scope_fact(fact: DataFrame, cfg: C.JobConfig) -> DataFrame:
    """Rows of the campaign fact inside the run: apps, markets, trusted channels, window,
    new-install campaigns. The channel test reads the raw name, before any alias."""
    w = cfg.window
    return fact.where(
        F.col(C.APP).isin(list(cfg.apps))
        & F.col(C.MARKET).isin(list(cfg.markets))
        & ~F.col(C.CHANNEL).like(cfg.excluded_channel_pattern)
        & F.col(C.DATE).between(F.lit(w.start), F.lit(w.end))
        & (F.col("MVP_CAMPAIGN_TYPE") == F.lit(cfg.campaign_type))
    )


def campaign_rollup(fact: DataFrame, cfg: C.JobConfig, cards: CardBook | None = None) -> DataFrame:
    """X1: spend, installs, retention and net revenue / LTV per campaign and day (K6).

    Groups with neither positive spend nor positive installs are dropped. Shares are the configured ones, or those of
    ``cards``, which the groups that are left meet once.
    """
    if cards is not None:
        return _campaign_rollup_by_cards(fact, cfg, cards)
    folded = fold_organic(scope_fact(fact, cfg), cfg.paid_source_types, cfg.channel_alias)
    book = RateBook(cfg)
    sub_card = book.subscription_revenue()

    types = column_types(fact)

    def g(column: str) -> str:
        return group_sum(types, column)

    aggs = renamed_sums(
        ["EXPENSE_AMT", "USER_QTY", *C.RETENTION_METRICS],
        ["SPEND", C.INSTALL_RAW, *C.RETENTION_METRICS],
    )
    for d in C.REVENUE_DAYS:
        day = f"{d:03d}"
        overrides = {app: g(col) for app, col in book.tier_c_day1_overrides(d).items()}
        aggs += [
            rated(book.iap.sql(g(f"REVS_DAY_{day}_AMT"), overrides=overrides), f"IAP_REVS_DAY_{day}_AMT"),
            rated(book.ad.sql(g(f"AD_REVS_DAY_{day}_AMT")), f"AD_REVS_DAY_{day}_AMT"),
            rated(sub_card.sql(g(f"SUBSCRIPTIONS_REVS_DAY_{day}_AMT")), f"SUB_REVS_DAY_{day}_AMT"),
        ]
    aggs += [
        rated(book.iap.sql(g("LTV_365_LASTEST_VAL")), "IAP_LTV"),
        rated(book.ad.sql(g("AD_LTV_365_LASTEST_VAL")), "AD_LTV"),
    ]
    out = (
        folded.groupBy(*C.K6)
        .agg(*aggs)
        .where((F.col("SPEND") > 0) | (F.col(C.INSTALL_RAW) > 0))
    )
    return normalize_decimals(out, C.METRICS_RAW)


def _campaign_rollup_by_cards(fact: DataFrame, cfg: C.JobConfig, cards: CardBook) -> DataFrame:
    folded = fold_organic(scope_fact(fact, cfg), cfg.paid_source_types, cfg.channel_alias)
    types = column_types(fact)
    gross = {}
    for d in C.REVENUE_DAYS:
        day = f"{d:03d}"
        gross |= {f"IAP_REVS_DAY_{day}_AMT": ("IAP", f"REVS_DAY_{day}_AMT"), f"AD_REVS_DAY_{day}_AMT": ("AD", f"AD_REVS_DAY_{day}_AMT")}
        gross |= {f"SUB_REVS_DAY_{day}_AMT": ("SUB", f"SUBSCRIPTIONS_REVS_DAY_{day}_AMT")}
    gross |= {"IAP_LTV": ("IAP", "LTV_365_LASTEST_VAL"), "AD_LTV": ("AD", "AD_LTV_365_LASTEST_VAL")}
    groups = folded.groupBy(*C.K6).agg(
        *renamed_sums(["EXPENSE_AMT", "USER_QTY", *C.RETENTION_METRICS], ["SPEND", C.INSTALL_RAW, *C.RETENTION_METRICS]),
        *[carded_sum(types, column, f"GROSS_{name}") for name, (_, column) in gross.items()],
    )
    nets = {name: (kind, sql_col(f"GROSS_{name}")) for name, (kind, _) in gross.items()}
    for d in C.REVENUE_DAYS:  # the published job's quirk: some applications' later days read day 1
        for app in RateBook(cfg).tier_c_day1_overrides(d):
            later = f"CASE WHEN {C.APP} = {sql_str(app)} THEN GROSS_IAP_REVS_DAY_001_AMT ELSE GROSS_IAP_REVS_DAY_{d:03d}_AMT END"
            nets[f"IAP_REVS_DAY_{d:03d}_AMT"] = ("IAP", later)
    out = netted(groups.where((F.col("SPEND") > 0) | (F.col(C.INSTALL_RAW) > 0)), cards, nets)
    order = [*C.K6, "SPEND", C.INSTALL_RAW, *C.RETENTION_METRICS, *gross]
    return normalize_decimals(out.select(*order), C.METRICS_RAW)


#: how many equal installs a row stands for, where installs come counted
INSTALLS = "INSTALLS"
#: integer digits kept for one user's summed projection, and for an install count: their
#: product has (16 + s) + 10 + 1 digits, which stays within 38 for every scale allowed
USER_LTV_INT_DIGITS = 16
COUNT_DIGITS = 10


def latest_user_ltv(projections: DataFrame) -> DataFrame:
    """One row per user key: how many latest (tied) projection rows it has and their
    summed subscription projection.

    One scan of the history and two aggregates, both map-side first: rows are counted and summed
    per user and date, and of a user's dates the last one's figures are kept. Tied rows have
    one date, so they stay counted; rows without a key or a date never qualify.
    """
    sub = "SUB_PROJECTEDREVENUE_365"
    dtype = projections.schema[sub].dataType
    total = f"sum({sql_col(sub)})"
    if isinstance(dtype, T.DecimalType):
        if dtype.scale > C.MAX_INPUT_SCALE:
            raise ValueError(f"{sub} has scale {dtype.scale}: inputs may have {C.MAX_INPUT_SCALE} digits of scale")
        total = f"CAST({total} AS DECIMAL({USER_LTV_INT_DIGITS + dtype.scale},{dtype.scale}))"
    dated = projections.where(
        " AND ".join(f"{sql_col(c)} IS NOT NULL" for c in (*C.USER_KEY, "PROJECTION_DT"))
    )
    by_date = dated.groupBy(*C.USER_KEY, "PROJECTION_DT").agg(
        F.count(F.lit(1)).alias("DATE_ROWS"), F.expr(f"{total} AS DATE_SUB_LTV")
    )
    return by_date.groupBy(*C.USER_KEY).agg(
        F.max_by("DATE_ROWS", "PROJECTION_DT").alias("LATEST_ROWS"),
        F.max_by("DATE_SUB_LTV", "PROJECTION_DT").alias("LATEST_SUB_LTV"),
    )


def scope_installs(installs: DataFrame, cfg: C.JobConfig) -> DataFrame:
    """Install records inside the run: apps, markets, window. Channel and campaign type are tested only where
    the configuration asks for it (the published job does not), on the raw channel name, before any alias."""
    w = cfg.window
    scoped = installs.withColumnRenamed("INSTALL_DT", C.DATE).where(
        F.col(C.APP).isin(list(cfg.apps))
        & F.col(C.MARKET).isin(list(cfg.markets))
        & F.col(C.DATE).between(F.lit(w.start), F.lit(w.end))
    )
    if cfg.install_excluded_channel_pattern is not None:
        scoped = scoped.where(~F.col(C.CHANNEL).like(cfg.install_excluded_channel_pattern))
    if cfg.install_campaign_type is not None:
        spelled = [c for c in installs.columns if c.upper() == "MVP_CAMPAIGN_TYPE"]
        if not spelled:
            raise ValueError("installs: missing MVP_CAMPAIGN_TYPE, which install_campaign_type tests")
        scoped = scoped.where(F.col(sql_col(spelled[0])) == F.lit(cfg.install_campaign_type))
    return scoped


def install_ltv_rollup(
    installs: DataFrame, projections: DataFrame, cfg: C.JobConfig, cards: CardBook | None = None
) -> DataFrame:
    """X5: installs joined to each user's latest projection, netted and summed per K6.

    Equals joining every install to every tied latest projection row and summing per row:
    the share depends only on install columns, so ``sum(rate * v) = rate * sum(v)`` exactly
    in decimal arithmetic, and a NULL projection contributes 0 either way.

    Skew: installs are first counted per (user key, campaign columns) with a partial
    aggregate, so a user key holding a large share of all installs (a sentinel account)
    reaches the join as one row per campaign and day, not one row per install. The user
    side is already one row per key. Both multiplications by the counts are exact. Installs that come counted
    (a column ``INSTALLS``) keep their counts.
    """
    scoped = scope_installs(installs, cfg)
    counted = F.sum(INSTALLS) if INSTALLS in installs.columns else F.count(F.lit(1))
    scoped = scoped.groupBy(*C.USER_KEY, *C.K6).agg(counted.alias(INSTALLS))
    joined = scoped.join(latest_user_ltv(projections), on=list(C.USER_KEY), how="inner")
    alias = cfg.channel_alias if cfg.alias_install_channels else None
    folded = fold_organic(joined, cfg.paid_source_types, alias).withColumns(
        {
            "MATCHED_ROWS": F.col(INSTALLS) * F.col("LATEST_ROWS"),
            "MATCHED_SUB_LTV": F.col("LATEST_SUB_LTV")
            * F.col(INSTALLS).cast(T.DecimalType(COUNT_DIGITS, 0)),
        }
    )
    if cards is not None:
        matched = carded_sum(column_types(folded), "MATCHED_SUB_LTV", "GROSS_SUB_LTV")
        groups = folded.groupBy(*C.K6).agg(sum_of("MATCHED_ROWS", "INDIVIDUAL_INSTALLS"), matched)
        out = netted(groups, cards, {"SUB_LTV": ("SUB_LTV", "GROSS_SUB_LTV")})
        return normalize_decimals(out.select(*C.K6, "INDIVIDUAL_INSTALLS", "SUB_LTV"), ["SUB_LTV"])
    card = RateBook(cfg).subscription_ltv()
    out = folded.groupBy(*C.K6).agg(
        sum_of("MATCHED_ROWS", "INDIVIDUAL_INSTALLS"),
        rated(card.sql(group_sum(column_types(folded), "MATCHED_SUB_LTV")), "SUB_LTV"),
    )
    return normalize_decimals(out, ["SUB_LTV"])


def skan_rollup(skan: DataFrame, cfg: C.JobConfig, cards: CardBook | None = None) -> DataFrame:
    """X7: SKAN postbacks per campaign and install day, in the campaign schema.

    Market is always iOS and SOURCE is SKAN; metrics SKAN does not report are zero.
    The window runs to the day before the run date (not lagged like the MMP side).
    """
    w = cfg.window
    scoped = skan.where(
        F.col(C.APP).isin(list(cfg.apps))
        & ~F.col(C.CHANNEL).like(cfg.excluded_channel_pattern)
        & (F.col("INSTALL_DT") >= F.lit(w.start))
        & (F.col("INSTALL_DT") < F.lit(w.skan_end_exclusive))
    )
    types, gross = column_types(skan), "GROSS_IAP_LTV_365_LATEST_VAL"
    if cards is None:
        net = rated(RateBook(cfg).iap.sql(group_sum(types, gross)), "IAP_LTV")
    else:
        net = carded_sum(types, gross, "GROSS_IAP_LTV")
    agg = scoped.groupBy(C.APP, C.CHANNEL, "PROMOTION_CD", "INSTALL_DT").agg(
        *renamed_sums(["INSTALL_NUM", "NET_OVERALL_LTV_365_LATEST_VAL"], [C.INSTALL_RAW, "TOTAL_LTV"]), net
    )
    if cards is not None:
        dated = agg.withColumns({C.MARKET: F.lit(C.IOS_MARKET), C.DATE: F.col("INSTALL_DT")})
        agg = netted(dated, cards, {"IAP_LTV": ("IAP", "GROSS_IAP_LTV")})
    zero = zero_metric()
    reported = {C.INSTALL_RAW, "IAP_LTV", "TOTAL_LTV"}
    out = agg.select(
        C.APP,
        F.lit(C.IOS_MARKET).alias(C.MARKET),
        F.lit(C.SKAN_SOURCE).alias(C.SOURCE),
        C.CHANNEL,
        F.col("PROMOTION_CD").alias(C.PROMOTION),
        F.col("INSTALL_DT").alias(C.DATE),
        *[
            F.col(m) if m in reported else zero.alias(m)
            for m in C.METRICS_RAW
            if m != "SPEND"
        ],
    )
    return normalize_decimals(out, C.METRICS_RAW)


def channel_rollup(campaign: DataFrame) -> DataFrame:
    """X10: the complete campaign table summed to channel grain (promotion dropped)."""
    out = campaign.groupBy(*C.KCH).agg(*sum_metrics(C.METRICS))
    return normalize_decimals(out, C.METRICS)


def game_rollup(df: DataFrame) -> DataFrame:
    """X11: last install date, total spend and total installs per app, market and source."""
    out = df.groupBy(*C.KG).agg(
        F.max(C.DATE).alias("LAST_INSTALL_DT"),
        # a publication has 32-bit floats: summed as decimals, the order of rows does not matter
        F.sum(F.col("SPEND").cast(C.METRIC_DECIMAL)).alias("TOTAL_SPEND"),
        F.sum(C.INSTALL).alias("TOTAL_INSTALL"),
    )
    return normalize_decimals(out, ["TOTAL_SPEND", "TOTAL_INSTALL"])

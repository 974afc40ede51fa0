"""Builders of hand-written input rows with the production column names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from spendlens import config as C

MONEY = T.DecimalType(18, 2)

FACT_MEASURES = (
    ["EXPENSE_AMT", "USER_QTY", *C.RETENTION_METRICS]
    + [f"{k}_DAY_{d:03d}_AMT" for d in C.REVENUE_DAYS for k in ("REVS", "AD_REVS", "SUBSCRIPTIONS_REVS")]
    + ["LTV_365_LASTEST_VAL", "AD_LTV_365_LASTEST_VAL"]
)
FACT_SCHEMA = T.StructType(
    [
        T.StructField(C.APP, T.StringType()),
        T.StructField(C.MARKET, T.StringType()),
        T.StructField("MVP_CAMPAIGN_TYPE", T.StringType()),
        T.StructField(C.SOURCE_TYPE, T.StringType()),
        T.StructField(C.CHANNEL, T.StringType()),
        T.StructField(C.PROMOTION, T.StringType()),
        T.StructField(C.DATE, T.DateType()),
        *[T.StructField(m, MONEY) for m in FACT_MEASURES],
    ]
)


def fact_row(app="OTHER", market="IT", source="MK", channel="ADWORDS", promo="P1",
             date=dt.date(2022, 5, 1), ctype="New Installs", **measures):
    vals = [measures.get(m) for m in FACT_MEASURES]
    return (app, market, ctype, source, channel, promo, date, *vals)


def fact_df(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def campaign_schema(with_source=False, with_spend=True, metrics=C.METRICS_RAW, with_source_type=True):
    keys = [C.APP, C.MARKET] + ([C.SOURCE] if with_source else [])
    keys += ([C.SOURCE_TYPE] if with_source_type else []) + [C.CHANNEL, C.PROMOTION]
    fields = [T.StructField(k, T.StringType()) for k in keys] + [T.StructField(C.DATE, T.DateType())]
    fields += [T.StructField(m, C.METRIC_DECIMAL) for m in metrics if with_spend or m != "SPEND"]
    return T.StructType(fields)

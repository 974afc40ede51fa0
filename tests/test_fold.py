from __future__ import annotations

from pyspark.sql import types as T

from spendlens import config as C
from spendlens.functions.fold import fold_organic


def test_fold_paid_unpaid_null_and_alias(spark):
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in (C.SOURCE_TYPE, C.CHANNEL, C.PROMOTION)]
    )
    rows = [
        ("MM", "SKANUAC", "p1"),
        ("MK", "SKANFB", "p2"),
        ("MC", "UNITY", "p3"),
        ("MK", None, "p4"),
        ("US", "SKANUAC", "p5"),
        ("OT", "UNITY", "p6"),
        (None, "UNITY", "p7"),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in fold_organic(df).collect()]
    assert got == [
        ("MM", "ADWORDS", "p1"),
        ("MK", "SGNFB", "p2"),
        ("MC", "UNITY", "p3"),
        ("MK", None, "p4"),
        ("US", "ORGANIC", "ORGANIC"),
        ("OT", "ORGANIC", "ORGANIC"),
        (None, "ORGANIC", "ORGANIC"),  # NULL source type folds but stays NULL
    ]
    no_alias = [tuple(r) for r in fold_organic(df, channel_alias=None).collect()]
    assert no_alias[0] == ("MM", "SKANUAC", "p1")

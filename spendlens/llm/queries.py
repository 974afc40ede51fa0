"""Thin registered queries over the operators: production parameters, whole tables.

Each derives the digest columns of its contract from its operator's own outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, merkle_log, near_dedup, pivotal_grams, quality_knn, quality_rules, repeat_tree, secrets, substring_dedup, toxicity, url_filter, warc
from .common import bounded_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


URL_RULES = (
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.fit(docs))
    listed = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    return found.selectExpr(
        "doc_id",
        *[f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in ("assign", "access", "hex")],
        f"sha2({listed.format("filter(spans, s -> s.kind != 'crf')")}, 256) AS base_sha256",
        f"{listed.format('spans')} AS spans",
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.share_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.clean_lines(docs, out_col="q").selectExpr(
        "doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words", "q.base_failed", "q.kept"
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = quality_knn.pack_terms(_table(spark, sf_dir, "documents"))
    return quality_knn.score(packed, quality_knn.fit(packed, _table(spark, sf_dir, "labels")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = warc.write_archives(_table(spark, sf_dir, "pages"))
    records = warc.read_archives(warc.normalise_archives(report))
    return records.select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    made = merkle_log.Manifest(_table(spark, sf_dir, "documents"), altered={"text": text})
    return made.verified().withColumnRenamed("id", "doc_id")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeat_tree.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_grams.group_variants(pivotal_grams.count_words(_table(spark, sf_dir, "documents"), drop_every=31))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_secret_scan": op3_secret_scan,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_dedup": op6_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

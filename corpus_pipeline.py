"""A training corpus from ``documents``: clean, deduplicate, decontaminate, redact, tokenise.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir) and returns a
DataFrame; ``run`` writes each as Parquet in the folder executors share and reads it back as the
next one's ``docs``, so a stage's work is done once and survives any executor. Every stage works
on all rows that the one before it kept. All but the last return the columns of their input.

Defined results: a null text is empty; a document without words fails the quality rules and goes, so empty
texts get no further; rows that repeat an id and a text are judged alike and stay or go together;
of near copies the smallest id stays, with every row of that id, and a null id only if no copy of it has
one; very long texts and ties are the operators' matter (see their modules); extra columns, whatever
their names, are returned by all stages but the last as they came; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import bpe, decontaminate, near_dedup, quality_rules, secrets
from spendlens.llm.common import bounded_batches, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules reject go; failing lines go from the others.

    A document without a failing line keeps its text as it is, blank lines included.
    """
    judged = "".join(docs.columns) + "_judged"  # longer than any column's name, so none has it
    out = quality_rules.clean_lines(docs, out_col=judged).where(F.col(f"`{judged}`.kept"))
    text = F.when(F.col(f"`{judged}`.lost_chars") > 0, F.col(f"`{judged}`.text")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the smallest id."""
    return near_dedup.drop_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; benchmark passages go from documents below the limit."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark, length_col="n_chars")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs, secrets.fit(docs), length_col="n_chars")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    ranks = bpe.share_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("byte_bpe", bpe_stage),
]

#: SQL can express neither the conditional random field nor the merges
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

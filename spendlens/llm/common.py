"""Helpers shared by the operators of this subpackage.

Conventions: a null text counts as the empty text; a *word* is a maximal run of bytes other
than space and ``\\t\\n\\v\\f\\r`` (``bytes.split()`` splits exactly there); operators read only
the id and text columns they are given and put them under private names first, so any extra
column, whatever its name, passes by unread.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Scratch, delete_path, shared_folder

#: rows and bytes of one Arrow batch: a task holds one batch of texts at a time, so very long
#: documents never add up in a Python worker
BATCH_ROWS = 1_000
BATCH_BYTES = 8 << 20

#: regular-expression class (Java, RE2 and Python alike) of the bytes between words
BLANKS = r"[\x20\x09-\x0D]"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches sent to Python workers in rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts(df: DataFrame, id_col: str, text_col: str, binary: bool = False) -> DataFrame:
    """(_id, _text): the two columns an operator reads; null text becomes empty."""
    bounded_batches(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("_id"), (text.cast("binary") if binary else text).alias("_text"))


def carried(df: DataFrame, text_col: str, binary: bool = False) -> DataFrame:
    """(_row, _text): all other columns in one struct, so that no name can clash, and the text."""
    bounded_batches(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    return df.select(F.struct(*others).alias("_row"), (text.cast("binary") if binary else text).alias("_text"))


def restored(df: DataFrame, like: DataFrame, text_col: str, text: Column, length_col: str | None = None) -> DataFrame:
    """The columns of ``like`` from a ``carried`` relation, with ``text`` as the text and, if there
    is such a column, its length in ``length_col``."""

    def column(f: T.StructField) -> Column:
        if f.name == text_col:
            return text.alias(f.name)
        if f.name == length_col:
            return F.length(text).cast(f.dataType).alias(f.name)
        return F.col("_row").getField(f.name).alias(f.name)

    return df.select(*map(column, like.schema.fields))


def map_columns(df: DataFrame, run: Callable, drop: tuple[str, ...] = (), **added: str) -> DataFrame:
    """``df.mapInArrow(run)``, its schema being that of ``df`` without ``drop`` and with ``added``."""
    kept = [f for f in df.schema.fields if f.name not in drop and f.name not in added]
    new = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in added.items()))
    return df.mapInArrow(run, T.StructType([*kept, *new.fields]))


def with_columns(batch: pa.RecordBatch, drop: tuple[str, ...] = (), **added: pa.Array) -> pa.RecordBatch:
    """``batch`` without ``drop`` and with ``added``, in the order of ``map_columns``."""
    kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n not in drop and n not in added}
    return pa.RecordBatch.from_arrays([*kept.values(), *added.values()], [*kept, *added])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: the files outlive any executor, and later steps read them instead
    of computing the relation again.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drawn(df: DataFrame, draw: Column, most: int) -> DataFrame:
    """A sample of at most ``most`` rows: all, if there are no more, else those whose draw (a hash
    of 63 bits) is below the share wanted.

    The share aims three standard deviations below ``most``. Nothing is sorted or gathered for
    it: a top-k would send that many rows of every partition to one place.
    """
    n = df.count()
    if n <= most:
        return df
    return df.where(draw < int((most - 3 * most**0.5) / n * 2**63))


def hash63(*columns: Column | str) -> Column:
    """A hash of the columns as a non-negative 64-bit integer."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


class WordHashes(dict):
    """Word -> 64-bit hash, remembered for at most ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers (splitmix64's), vectorised."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list, ...]]:
    """The named columns of each non-empty batch as Python lists."""
    for b in batches:
        if b.num_rows:
            yield tuple(b.column(c).to_pylist() for c in columns)


def whole_runs(batches: Iterator[pa.RecordBatch], *keys: str, least: int = 1) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of at least ``least`` that end where the keys (integers) change, and where each run of
    equal keys starts, from batches in which equal keys are neighbours."""
    held: list[pa.RecordBatch] = []
    n = 0

    def starts(rows: pa.Table) -> np.ndarray:
        columns = [rows.column(k).to_numpy() for k in keys]
        return np.append(0, np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1)

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n > least:
            rows = pa.Table.from_batches(held)
            first = starts(rows)
            if first[-1] >= least:
                yield rows.slice(0, first[-1]), first[:-1]
                held = rows.slice(first[-1]).combine_chunks().to_batches()
                n = rows.num_rows - int(first[-1])
    if held:
        rows = pa.Table.from_batches(held)
        yield rows, starts(rows)


def released(scratch: Scratch, *names: str) -> None:
    """Delete relations that no later step reads, and have the driver drop the shuffles of finished
    steps (Spark removes their files once the driver has collected the plans they belong to)."""
    for name in names:
        delete_path(scratch.spark, scratch.path(name))
    scratch.spark._jvm.System.gc()

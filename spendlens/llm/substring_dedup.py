"""Exact substring deduplication by Rabin-Karp hashes of every ``window``-word window.

A window is ``window`` consecutive words of one document. A word is removed if some window
that covers it also starts in a document with a smaller id; windows are judged on the input.

A document whose text another one with a smaller id has too loses all its windows, so only the
first of equal texts goes on. Every window of those is hashed by a polynomial (Rabin-Karp) rolling
hash over 128 bits, taken from prefix sums, and windows are counted in Spark in two steps:

1. *Anchors.* The lowest hash of the ``gram``-word runs inside a window is its anchor: equal
   windows have equal anchors, and neighbouring windows mostly share theirs, so a document has
   about one anchor for eighteen words. A window whose anchor occurs in one document only
   cannot repeat elsewhere; the others go on. This test is exact: it loses no window.
2. *Windows.* Of the rest, each different window of a document is one row. ``min(id)`` by
   window hash is aggregated (map-side first), and a window whose hash has a smaller id than
   its own document's is removed, wherever it stands there. Removed windows of a document
   merge into maximal word intervals.

Scale: no step gathers the rows of a passage. Both counts are partial aggregates, so a passage
that a third of all documents hold costs a row for each task; the joins back are on the hash
and splittable where one is hot. A document's own anchors and windows are bounded by its length.
Texts are shuffled once, by document, and that exchange serves both joins on it.

Defined results: a null or empty text has no words and no windows; a null id counts as larger
than any other id, and null ids do not remove from each other; rows that repeat an id are
one document (they do not remove from each other); texts of under ``window`` words stay.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix64, texts, written

WINDOW = 50
GRAM = 16

#: odd multipliers of the two polynomial hashes
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class RollingHash:
    """Hashes of all runs of k words, from one prefix sum over the document.

    With S[i] the sum of h[j] * B^j for j < i, the run from i has the hash (S[i+k] - S[i]) * B^-i,
    all modulo 2^64 (B is odd, so it has an inverse): the same for equal runs wherever they stand.
    """

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        size = max(n, 2 * len(self.powers))
        for name, b in (("powers", self.base), ("inverses", self.inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            setattr(self, name, np.multiply.accumulate(p))

    def prefix(self, h: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(h):
            self._grow(len(h) + 1)
        s = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.powers[: len(h)], out=s[1:])
        return s

    def runs(self, prefix: np.ndarray, k: int) -> np.ndarray:
        n = max(0, len(prefix) - k)
        return (prefix[k:] - prefix[:n]) * self.inverses[:n]


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """The minimum of every k consecutive values, by doubling."""
    width = 1
    while 2 * width <= k:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (k - width)], x[k - width :]) if k > width else x


class _Hasher:
    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, min(gram, window)
        self.words, self.rolling = WordHashes(), [RollingHash(b) for b in _BASES]

    def anchors(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """The anchor of each window, and the word hashes; nothing for under ``window`` words."""
        words = text.split()
        if len(words) < self.window:
            return None
        h = self.words.of(words)
        grams = mix64(self.rolling[0].runs(self.rolling[0].prefix(h), self.gram))
        return sliding_min(grams, self.window - self.gram + 1), h

    def windows(self, h: np.ndarray) -> list[np.ndarray]:
        out = []
        for k, rolling in enumerate(self.rolling):
            x = mix64(h) if k else h
            out.append(rolling.runs(rolling.prefix(x), self.window))
        return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _anchors(window, gram, batches):
    hasher = _Hasher(window, gram)
    for b in batches:
        of, found = [], []
        for i, text in enumerate(b.column("_text").to_pylist()):
            if (got := hasher.anchors(text)) is not None:
                found.append(_signed(np.unique(got[0])))
                of.append(i)
        if found:
            take = pa.array(of)
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(take) for c in ("_id", "_key", "_key2")), lists], ["_id", "_key", "_key2", "anchors"]
            )


def _windows(window, gram, batches):
    """A row for each different window of a document that has one of its wanted anchors."""
    hasher = _Hasher(window, gram)
    for b in batches:
        of, parts = [], []
        for i, (text, wanted) in enumerate(zip(b.column("_text").to_pylist(), b.column("wanted"))):
            anchors, h = hasher.anchors(text)
            h1, h2 = hasher.windows(h)
            start = np.flatnonzero(np.isin(_signed(anchors), np.asarray(wanted.values)))
            start = start[np.unique(h1[start], return_index=True)[1]]
            of.append(np.full(len(start), i))
            parts.append((_signed(h1[start]), _signed(h2[start])))
        if of:
            take = pa.array(np.concatenate(of))
            h1, h2 = (pa.array(np.concatenate(x)) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(take), b.column("_key").take(take), h1, h2], ["_id", "_key", "h1", "h2"]
            )


def merge_windows(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word intervals [start, end) that windows from the given starts cover."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    gap = np.flatnonzero(np.diff(starts) > window) + 1
    first = starts[np.concatenate(([0], gap))]
    last = starts[np.append(gap - 1, len(starts) - 1)] + window
    return list(zip(first.tolist(), last.tolist()))


def _cut(window, gram, batches):
    hasher = _Hasher(window, gram)
    for b in batches:
        n_words, spans, kept = [], [], []
        for text, gone, copy in zip(b.column("_text").to_pylist(), b.column("gone"), b.column("copy").to_pylist()):
            words = text.split()
            own = []
            if copy:
                own = [(0, len(words))]
            elif gone.is_valid:
                h1 = hasher.windows(hasher.words.of(words))[0]
                own = merge_windows(np.flatnonzero(np.isin(_signed(h1), np.asarray(gone.values))), window)
            n_words.append(len(words))
            spans.append([{"start": a, "end": z} for a, z in own])
            for a, z in reversed(own):
                del words[a:z]
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                b.column("_id"),
                pa.array(n_words, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            ["_id", "n_words", "spans", "kept"],
        )


def _held_by_others() -> F.Column:
    """Of rows grouped by a hash: whether more documents than one hold it."""
    nulls = F.max(F.col("_id").isNull())
    return (F.min("_id") < F.max("_id")) | (F.min("_id").isNotNull() & nulls)


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per document row: id, n_words, spans (removed word intervals [start, end)) and kept (the
    other words, joined by one space, UTF-8)."""
    base = texts(docs, id_col, text_col, binary=True).withColumn("_key", F.xxhash64("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    same_doc = lambda a, b: a["_id"].eqNullSafe(b["_id"]) & a["_key"].eqNullSafe(b["_key"])

    signed = written(
        base.withColumn("_key2", F.xxhash64(F.lit(1), "_text")).mapInArrow(
            partial(_anchors, window, gram), f"_id {id_type}, _key bigint, _key2 bigint, anchors array<bigint>"
        ),
        "anchors",
    )
    # equal texts: the first of them stands for all, and the others go
    first = signed.groupBy("_key", "_key2").agg(F.min("_id").alias("first"))
    later = (F.col("first") < F.col("_id")) | (F.col("_id").isNull() & F.col("first").isNotNull())
    marked = written(
        signed.join(first, ["_key", "_key2"]).select("_id", "_key", "anchors", F.coalesce(later, F.lit(False)).alias("copy")),
        "marked",
    )
    anchors = marked.where("NOT copy").select("_id", "_key", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(_held_by_others().alias("many")).where("many").select("anchor")
    wanted = (
        anchors.join(shared, "anchor")
        .groupBy("_id", "_key")
        .agg(F.collect_set("anchor").alias("wanted"))
    )
    windows = (
        base.join(wanted, same_doc(base, wanted))
        .select(base["_id"], base["_key"], "_text", "wanted")
        .mapInArrow(partial(_windows, window, gram), f"_id {id_type}, _key bigint, h1 bigint, h2 bigint")
    )
    owners = (
        windows.groupBy("h1", "h2")
        .agg(F.min("_id").alias("owner"), _held_by_others().alias("many"))
        .where("many")
        .select("h1", "h2", "owner")
    )
    removed = (
        windows.join(owners, ["h1", "h2"])
        .where((F.col("owner") < F.col("_id")) | F.col("_id").isNull())
        .groupBy("_id", "_key")
        .agg(F.collect_set("h1").alias("gone"))
        .select("_id", "_key", "gone", F.lit(False).alias("copy"))
        .union(marked.where("copy").select("_id", "_key").distinct().select("*", F.array().cast("array<bigint>"), F.lit(True)))
    )
    cut = (
        base.join(removed, same_doc(base, removed), "left")
        .select(base["_id"], "_text", "gone", "copy")
        .mapInArrow(
            partial(_cut, window, gram),
            f"_id {id_type}, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
        )
    )
    return cut.withColumnRenamed("_id", id_col)

"""Quality by nearest-neighbour voting among labelled documents, in a latent-semantic space.

Terms of a document are its words (hashed), the shapes of its words and marks, the shapes of
its lines, and how far it repeats itself; a term weighs (1 + ln count) * idf. The latent space is
spanned by the leading right singular vectors of the labelled documents' matrix (a randomised
singular value decomposition on the driver). The labelled vectors are broadcast; every document's
cosines with all of them are one exact matrix product a block of documents, and the labels of
the ``NEIGHBOURS`` nearest vote, weighted by similarity.

Scale: texts are read once: their term counts are written as packed rows, some hundred bytes
a document. Document frequencies are counted over all documents (map-side first, ``TERMS``
sums); scoring is one map over the packed rows. Training takes at most ``TRAIN_ROWS`` labelled
documents chosen by a hash of the id, so what is broadcast is at most ``TRAIN_ROWS`` vectors of
``RANK`` numbers and the projection of ``TERMS`` rows, whatever the input is.

Defined results: a null or empty text has the terms of an empty document and is scored by them;
ids whose crc32 (of the id as text) is divisible by ``HOLD_OUT`` are never learned from; null
labels are left out, a document labelled more than once counts as good if one label says so; without any
label every score is 0.5; a null id is not held out; repeated documents are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drawn, hash63, rows, texts, written

HOLD_OUT = 5
TRAIN_ROWS = 4_000
RANK = 48
NEIGHBOURS = 25
THRESHOLD = 0.3
#: buckets of hashed words, and of shapes and the other terms after them
WORD_TERMS, FORM_TERMS = 1_024, 1_024
TERMS = WORD_TERMS + FORM_TERMS
#: weight of a word term beside a form term (quality is in the form more than in the topic)
WORD_WEIGHT = 0.25

_SHAPES = bytes(
    ord("a") if 97 <= b <= 122 or b >= 0x80 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def _runs(shape: bytes) -> bytes:
    """A shape with its runs cut to one."""
    return bytes(c for i, c in enumerate(shape) if not i or shape[i - 1] != c)


def _form(feature: bytes) -> int:
    return WORD_TERMS + xxhash.xxh3_64_intdigest(feature) % FORM_TERMS


class Terms(dict):
    """Word -> its word term and form term, remembered for at most ``limit`` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit
        self.forms: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        shape = word.translate(_SHAPES)
        form = self.forms.get(shape)
        if form is None:
            if len(self.forms) >= self.limit:
                self.forms.clear()
            form = self.forms[shape] = _form(b"w" + _runs(shape))
        self[word] = both = (xxhash.xxh3_64_intdigest(word) % WORD_TERMS) * TERMS + form
        return both

    def counts(self, text: bytes) -> np.ndarray:
        """How often each term occurs in a text."""
        out = np.zeros(TERMS, np.int64)
        words = text.split()
        n = len(words)
        if n:
            both = np.fromiter(map(self.__getitem__, words), np.int64, n)
            out += np.bincount(both // TERMS, minlength=TERMS)
            out += np.bincount(both % TERMS, minlength=TERMS)
        # how far it repeats itself: neighbours alike, and different words, in sixteenths
        same = sum(a == b for a, b in zip(words, words[1:]))
        different = len(set(words))
        grade = n.bit_length()
        extra = [b"same %d" % (16 * same // max(n, 1)), b"different %d %d" % (grade // 2, 16 * different // max(n, 1)), b"length %d" % grade]
        for term in extra:
            out[_form(term)] += max(1, n // 8)
        for line in text.split(b"\n"):
            if line := line.strip():
                out[_form(b"line %d %s" % (len(line).bit_length(), line[-1:].translate(_SHAPES)))] += 1
        return out


def _pack(batches):
    terms = Terms()
    for b in batches:
        at, times = [], []
        for t in b.column("_text").to_pylist():
            counts = terms.counts(t)
            own = np.flatnonzero(counts)
            at.append(own.astype("<u2").tobytes())
            times.append(counts[own].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column("_id"), pa.array(at, pa.binary()), pa.array(times, pa.binary())], ["_id", "terms", "counts"]
        )


def _frequencies(batches):
    total = np.zeros(TERMS, np.int64)
    n = 0
    for (at,) in rows(batches, "terms"):
        n += len(at)
        total += np.bincount(np.frombuffer(b"".join(at), "<u2"), minlength=TERMS)
    own = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(own, -1)), pa.array(np.append(total[own], n))], ["term", "documents"]
    )


def weighted(at: list[bytes], times: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Term vectors of documents, one row each, of length one."""
    x = np.zeros((len(at), TERMS), np.float32)
    for i, (a, t) in enumerate(zip(at, times)):
        a = np.frombuffer(a, "<u2")
        x[i, a] = (1 + np.log(np.frombuffer(t, "<u4"))) * idf[a]
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_axes(x: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors of ``x`` as columns (randomised range finder)."""
    rng = np.random.default_rng(0)
    k = min(rank + 16, *x.shape)
    q = np.linalg.qr(x.T @ (x @ (x.T @ rng.standard_normal((len(x), k), np.float32))))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :rank].astype(np.float32)


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


@dataclass
class Voters:
    """What is broadcast: idf, the axes, the labelled latent vectors (length one) and their labels."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, at: list[bytes], times: list[bytes]) -> np.ndarray:
        """The similarity-weighted share of good labels among each document's nearest."""
        if not len(self.labels):
            return np.full(len(at), 0.5)
        cosine = _unit(weighted(at, times, self.idf) @ self.axes) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(cosine, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) + 1e-6
        return np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1, dtype=float), 0, 1)


def _vote(shared, block, batches):
    voters = shared.value
    for b in batches:
        at, times = b.column("terms").to_pylist(), b.column("counts").to_pylist()
        score = [voters.scores(at[k : k + block], times[k : k + block]) for k in range(0, len(at), block)]
        if score:
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(np.concatenate(score).astype(float))], ["_id", "score"])


def pack_terms(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, terms, counts) of every document, written to the shared folder."""
    base = texts(docs, id_col, text_col, binary=True)
    id_type = base.schema["_id"].dataType.simpleString()
    return written(base.mapInArrow(_pack, f"_id {id_type}, terms binary, counts binary"), "terms")


def fit(
    packed: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", max_rows: int = TRAIN_ROWS
) -> Voters:
    """Voters from at most ``max_rows`` labelled documents that are not held out."""
    counted = packed.mapInArrow(_frequencies, "term bigint, documents bigint").groupBy("term").agg(F.sum("documents").alias("n"))
    frequency = {r["term"]: r["n"] for r in counted.collect()}  # at most TERMS + 1 rows
    n = frequency.pop(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([frequency.get(t, 0) for t in range(TERMS)]))).astype(np.float32) + 0.1
    idf[:WORD_TERMS] *= WORD_WEIGHT
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    # at most max_rows ids: bounded, so they can be broadcast
    chosen = drawn(written(known, "labels"), hash63("_id"), max_rows)
    # (rows that repeat an id are one document, so repeats do not add to the sample)
    one = F.min(F.struct("terms", "counts")).alias("one")
    picked = packed.join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(one)
    sample = picked.select("label", "one.terms", "one.counts").collect()
    sample = sorted((bytes(r["terms"]), bytes(r["counts"]), r["label"]) for r in sample)
    if not sample:
        return Voters(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    at, times, y = zip(*sample)
    x = weighted(at, times, idf)
    axes = latent_axes(x, RANK)
    return Voters(idf, axes, _unit(x @ axes).astype(np.float32), np.array(y, float))


def score(packed: DataFrame, voters: Voters, *, id_col: str = "doc_id", block: int = 256, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: id, held_out, score (0 to 1) and predicted (score >= threshold)."""
    shared = packed.sparkSession.sparkContext.broadcast(voters)
    id_type = packed.schema["_id"].dataType.simpleString()
    out = packed.mapInArrow(partial(_vote, shared, block), f"_id {id_type}, score double")
    return out.select(
        F.col("_id").alias(id_col),
        held_out(F.col("_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

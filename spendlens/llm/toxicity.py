"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other, the overall verdict last; each model is a logistic
regression on which words and heads of words (their first ``HEADS`` characters, which inflected and
compound words have in common) a document has and on the log-odds that the models before it gave. For
training, those come from out-of-fold predictions: every fold's are made by models that have not
seen it, nor a copy of a text in it, so a later model learns how far earlier ones can be trusted on
new text. For scoring,
models fitted on all training rows run in the same order.

Only the overall label is given. A category's label is derived from it: the document is toxic
and has one of the category's cue words (``CATEGORIES``); the overall model learns its words from the
label alone.

Scale: one map over the documents. Training takes at most ``TRAIN_ROWS`` labelled documents, chosen
by a hash of the id (half of them labelled toxic, as far as there are). Their words are counted in
Spark; of the ``VOCABULARY`` that speak most for the label it comes to the driver which documents
have them, and those words with their weights are what is broadcast. No word has to pass a test of
significance: one with little evidence is scaled down (``evidence``), so the ridge holds it near 0.

Defined results: a null or empty text has no words and gets the models' base rates; null labels
are left out, a document labelled more than once is toxic if one label says so; without labels
of both classes every probability is the share of toxic labels (0 without any); repeated
documents are scored row by row; words of equal evidence are taken in byte order; a very long text is read
whole, as its different words; columns other than id, text and label pass by unread.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drawn, hash63, rows, texts, written
from .decontaminate import normal_words

# Fixed cue words of the derived categories, in the order of the chain.
CATEGORIES = {
    "insult": ("idiot", "moron", "loser", "clown", "stupid", "fool", "imbecile"),
    "contempt": ("trash", "scum", "worthless", "pathetic", "vermin", "garbage"),
    "disgust": ("disgusting", "filthy", "repulsive", "vile"),
}
OVERALL = "toxic"

TRAIN_ROWS = 8_000
VOCABULARY = 2_000
#: words in fewer training documents are left out
MIN_DOCUMENTS = 4
#: documents that a word's log-odds are shrunk by, and standard errors taken off them
PRIOR = 2.0
CAUTION = 2.0
#: lengths in characters of the heads of words that are features too
HEADS = (4, 5, 6, 7)
FOLDS = 5
L2 = 0.02
THRESHOLD = 0.5


def features(word: bytes) -> list[bytes]:
    """A word and its heads (marked by ``*``, which no word has)."""
    text = word.decode("utf-8", "replace")
    return [word, *(text[:n].encode() + b"*" for n in HEADS if len(text) > n)]


def evidence(n: np.ndarray, k: np.ndarray, rate: float) -> np.ndarray:
    """How far words in n documents, k of them of the class, speak for it: the lower bound of their
    shrunken log-odds against the class's share, or 0."""
    with_, without = k + PRIOR * rate, n - k + PRIOR * (1 - rate)
    odds = np.log(with_ / without) - np.log(rate / (1 - rate))
    return np.where(n >= MIN_DOCUMENTS, np.maximum(0, odds - CAUTION * np.sqrt(1 / with_ + 1 / without)), 0)


@dataclass
class Chain:
    """The vocabulary and, for each link, its name, word weights, weights of earlier links, bias."""

    words: dict[bytes, int]
    links: list[tuple[str, np.ndarray, np.ndarray, float]]

    def probabilities(self, present: list[np.ndarray]) -> np.ndarray:
        """One row a document (given as its vocabulary indices), one column a link."""
        size = np.array([len(p) for p in present])
        flat = np.concatenate(present) if size.sum() else np.zeros(0, int)
        doc = np.repeat(np.arange(len(present)), size)
        odds: list[np.ndarray] = []
        for _, word, earlier, bias in self.links:
            z = bias + np.bincount(doc, word[flat], len(present))
            odds.append(z + sum((w * o for w, o in zip(earlier, odds)), np.zeros(len(present))))
        return 1 / (1 + np.exp(-np.clip(np.column_stack(odds), -30, 30)))


class Sparse:
    """Rows of word indices, as what a linear model needs of them."""

    def __init__(self, present: list[np.ndarray], n_words: int):
        self.n, self.n_words = len(present), n_words
        self.word = np.concatenate(present) if present else np.zeros(0, int)
        self.doc = np.repeat(np.arange(self.n), [len(p) for p in present])

    def keep(self, use: np.ndarray) -> None:
        """Leave out the words that are not in use."""
        some = use[self.word]
        self.word, self.doc = self.word[some], self.doc[some]

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, w[self.word], self.n).astype(float)

    def gradient(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, r[self.doc], self.n_words).astype(float)


def logistic(present: list[np.ndarray], n_words: int, earlier: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of words and of earlier links, and bias, by accelerated gradient descent.

    Words take part as far as they speak for the class in these rows (the others weigh nothing, so
    a long clean text around a few such words does not outvote them).
    """
    m = Sparse(present, n_words)
    count = m.gradient(np.ones(m.n))
    with_y, rate = m.gradient(y), y.mean()
    part = evidence(count, with_y, rate)
    m.keep(part > 0)
    w, v, b = np.zeros(n_words), np.zeros(earlier.shape[1]), float(np.log((rate + 1e-9) / (1 - rate + 1e-9)))
    scale = np.maximum(np.abs(earlier).max(axis=0, initial=1.0), 1.0)
    e = earlier / scale
    # a step short enough for the largest curvature (a power iteration over the words in use)
    x = part / (np.linalg.norm(part) or 1.0)
    top = 1.0
    for _ in range(15):
        x = part * m.gradient(m.scores(part * x))
        top = float(np.linalg.norm(x)) or 1.0
        x /= top
    rate_ = 1 / (0.25 * (top + m.n * (1 + e.shape[1])) + L2)
    now, was, t = np.concatenate([w, v, [b]]), np.concatenate([w, v, [b]]), 1.0
    for _ in range(300):
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at = now + (t - 1) / after * (now - was)
        w, v, b = at[:n_words], at[n_words:-1], at[-1]
        p = 1 / (1 + np.exp(-np.clip(m.scores(part * w) + e @ v + b, -30, 30)))
        r = y - p
        g = np.concatenate([part * m.gradient(r) - L2 * w, e.T @ r - L2 * v, [r.sum()]])
        was, now, t = now, at + rate_ * g, after
        if np.abs(now - was).max() < 1e-5:
            break
    return part * now[:n_words], now[n_words:-1] / scale, float(now[-1])


def folds(docs_words: list[list[bytes]]) -> np.ndarray:
    """The fold of each document, by a hash of its words: copies of a text are in one, so what is predicted
    out of a fold has not seen them."""
    return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words)) % FOLDS for words in docs_words], int)


def train(docs_words: list[list[bytes]], toxic: np.ndarray) -> Chain:
    """A chain from the distinct words (and heads) of training documents and their labels."""
    counts = Counter(w for words in docs_words for w in words)
    common = [w for w, n in counts.items() if n >= MIN_DOCUMENTS]
    ours = Counter(w for words, y in zip(docs_words, toxic) if y for w in words)
    rate = min(max(float(np.mean(toxic)) if len(toxic) else 0.0, 1e-9), 1 - 1e-9)
    says = evidence(np.array([counts[w] for w in common], float), np.array([ours[w] for w in common], float), rate)
    kept = [w for _, w in sorted(zip(-says, common))[:VOCABULARY]]
    index = {w: i for i, w in enumerate(kept)}
    present = [np.array([index[w] for w in words if w in index], int) for words in docs_words]
    labels = {}
    for name, cues in CATEGORIES.items():
        has = np.array([any(c.encode() in words for c in cues) for words in map(set, docs_words)], bool)
        labels[name] = toxic * has
    labels[OVERALL] = toxic
    n = len(present)
    fold = folds(docs_words)
    out_of_fold = np.zeros((n, 0))
    links = []
    for name, y in labels.items():
        if 0 < y.sum() < n:
            links.append((name, *logistic(present, len(kept), out_of_fold, y)))
            odds = np.zeros(n)
            for k in range(FOLDS):
                rest = np.flatnonzero(fold != k)
                test = np.flatnonzero(fold == k)
                if not len(test) or not 0 < y[rest].sum() < len(rest):
                    odds[test] = links[-1][3]
                    continue
                w, v, b = logistic([present[i] for i in rest], len(kept), out_of_fold[rest], y[rest])
                odds[test] = Sparse([present[i] for i in test], len(kept)).scores(w) + out_of_fold[test] @ v + b
        else:
            rate = float(y.mean()) if n else 0.0
            odds = np.full(n, np.log((rate + 1e-12) / (1 - rate + 1e-12)))
            links.append((name, np.zeros(len(kept)), np.zeros(len(links)), float(odds[0]) if n else -30.0))
        out_of_fold = np.column_stack([out_of_fold, odds])
    return Chain(index, links)


def _distinct_words(batches):
    for b in batches:
        found = [sorted({f for w in set(normal_words(t)) for f in features(w)}) for t in b.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(found, pa.list_(pa.binary()))], ["label", "words"])


def _known_words(vocabulary, batches):
    """Rows of (label, words) with the words of the vocabulary alone, in order."""
    for label, words in rows(batches, "label", "words"):
        own = [[w for w in ws if w in vocabulary.value] for ws in words]
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(own, pa.list_(pa.binary()))], ["label", "words"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = OVERALL,
    max_rows: int = TRAIN_ROWS,
) -> Chain:
    """A chain trained on at most ``max_rows`` of the labelled documents."""
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    known = written(known, "labels")
    halves = [drawn(known.where(F.col("label") == k), hash63("_id"), max_rows // 2) for k in (0, 1)]
    chosen = halves[0].union(halves[1])
    base = texts(docs, id_col, text_col, binary=True)
    # at most max_rows ids: bounded, so they can be broadcast
    # (rows that repeat an id are one document, so repeats do not add to the sample)
    picked = base.join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(F.min("_text").alias("_text"))
    sample = written(picked.mapInArrow(_distinct_words, "label int, words array<binary>"), "sample")
    n, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    rate = (toxic or 0) / max(n, 1)
    # a word that speaks for a category speaks for the overall label too: the others stay behind
    counted = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")
    )
    # the order of ``evidence``
    with_, without = F.col("k") + PRIOR * rate, F.col("n") - F.col("k") + PRIOR * (1 - rate)
    says = F.log(with_ / without) - CAUTION * F.sqrt(1 / with_ + 1 / without)
    telling = counted.where((F.col("n") >= MIN_DOCUMENTS) & (F.col("k") > F.col("n") * rate)) if 0 < rate < 1 else counted.limit(0)
    vocabulary = [bytes(r["word"]) for r in telling.orderBy(says.desc(), "word").limit(VOCABULARY).collect()]
    vocabulary += [c.encode() for cues in CATEGORIES.values() for c in cues]
    known_words = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))  # VOCABULARY and the cues at most
    held = sample.mapInArrow(partial(_known_words, known_words), sample.schema).collect()
    found = sorted(([bytes(w) for w in r["words"]], r["label"]) for r in held)
    return train([w for w, _ in found], np.array([y for _, y in found], float))


class Indices(dict):
    """Word -> vocabulary indices of its features, remembered for at most ``limit`` words."""

    def __init__(self, vocabulary: dict[bytes, int], limit: int = 200_000):
        super().__init__()
        self.vocabulary, self.limit = vocabulary, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        self[word] = own = tuple(self.vocabulary[f] for f in features(word) if f in self.vocabulary)
        return own


def _score(shared, names, batches):
    chain = shared.value
    indices = Indices(chain.words)
    for b in batches:
        present = []
        for t in b.column("_text").to_pylist():
            own = {i for w in set(normal_words(t)) for i in indices[w]}
            present.append(np.fromiter(own, int, len(own)))
        p = chain.probabilities(present)
        yield pa.RecordBatch.from_arrays(
            [b.column("_id"), *(pa.array(p[:, k]) for k in range(len(names)))], ["_id", *names]
        )


def score(docs: DataFrame, chain: Chain, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: id, p_<category> of every link, p_toxic, and toxic (one is >= threshold)."""
    base = texts(docs, id_col, text_col, binary=True)
    names = [f"p_{name}" for name, *_ in chain.links]
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    id_type = base.schema["_id"].dataType.simpleString()
    out = base.mapInArrow(partial(_score, shared, names), f"_id {id_type}, {', '.join(f'{n} double' for n in names)}")
    return out.withColumnRenamed("_id", id_col).withColumn("toxic", F.greatest(*map(F.col, names)) >= threshold)

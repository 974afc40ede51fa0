"""Spelling variants: words one code point apart, grouped under their frequent forms.

Two words are *near* if one inserted, deleted or replaced code point turns one into the other. A
word's *form* is its near word that occurs most, if that occurs at least ``ratio`` times as often; its
*root* is where forms lead in the end.

Near words are found by pivotal grams. Bigrams are ordered by how many words hold them, rarest first.
A word's *gram prefix* is its ``prefix`` rarest bigrams (and all places of the last one). Two disjoint
bigrams of the prefix are its *pivots*: dynamic programming picks the pair that the fewest words should
share in their places, estimated from counts of bigrams, first and last ones. One edit cannot
break both pivots, and a pivot of the word whose prefix ends earlier in the order stands in the other
word's prefix too, if it is intact there. So the pivots of a word are joined with the prefixes of others. The
positions of pivots bound the join: an edit behind the left pivot leaves it at its distance from the word's start
(with all before it), an edit up to the left pivot's end leaves the right pivot at its distance
from the word's end (with all behind it), and edits inside leave the first and last code points; edits of
these have keys of their own, the rest of the word. What meets is verified by edit distance within the join.
Pairs with a word of under 4 or over ``LONG`` code points meet by the half that the edit leaves: there, prefixes
are no smaller than words.

Scale: words are counted per batch in the worker, then by partial aggregates in Spark, and all joins are on
words or 64-bit keys, splittable where one is hot. Only the counts of bigrams reach the driver and the
workers: at most 65,536, since code points count modulo 256 there (so an order that other letters share, which
loses nothing). A word's near words are bounded by its length and the alphabet. Forms grow by ``ratio``
each step, so the roots are found in a few rounds of pointer doubling.

Defined results: a null or empty text has no words; a null id counts as the empty string; repeated rows
count as often as they stand there; ties of forms go to the smallest word in code-point order; very long words
are words; an empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import released, texts

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
PREFIX = 5
LONG = 64
SHORT = 4
#: words of a task that makes keys: a word is small, but has some fifteen keys
TASK_WORDS = 50_000

#: Latin-1 bytes to words: A-Z lower-cased, other letters of [a-zÀ-ÿ] kept, the rest blank
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def _counted(least: int, drop_every: int | None, batches):
    for b in batches:
        total: Counter[bytes] = Counter()
        for i, text in zip(b.column("_id").to_pylist(), b.column("_text").to_pylist()):
            # code points beyond Latin-1 become "?", which is blank as they are
            found = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
            seed = zlib.crc32(f"{'' if i is None else i}:".encode())
            for word, n in found.items():
                if drop_every:
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if not h % drop_every:
                        x = h % len(word)
                        word = word[:x] + word[x + 1 :]
                if len(word) >= least:
                    total[word] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
        )


def count_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    drop_every: int | None = None,
) -> DataFrame:
    """(word, n) of the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.

    With ``drop_every``, a run whose checksum h (crc32 of ``<id>:<run>``) it divides loses its code point
    h modulo its length before it is counted.
    """
    counts = texts(docs, id_col, text_col).mapInArrow(
        partial(_counted, least_length, drop_every), "word string, n bigint"
    )
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _grams(word: str) -> np.ndarray:
    codes = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.int64) & 255
    return codes[:-1] << 8 | codes[1:]


def _gram_counts(batches):
    """Counts of bigrams: all, first ones and last ones of words."""
    counts = np.zeros((3, 1 << 16), np.int64)
    for b in batches:
        for word in b.column("word").to_pylist():
            if len(word) > 1:
                g = _grams(word)
                np.add.at(counts[0], g, 1)
                counts[1, g[0]] += 1
                counts[2, g[-1]] += 1
    gram = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(gram), *(pa.array(c[gram]) for c in counts)], ["gram", "n", "first", "last"])


class GramOrder:
    """The order of bigrams, and how many words should share a bigram in its place."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.rank = np.full(1 << 16, 1 << 16, np.int32)
        self.rank[gram[np.lexsort((gram, n))]] = np.arange(len(gram))
        table = np.zeros((3, 1 << 16))
        table[:, gram] = n, first, last
        pairs = table[0].reshape(256, 256)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.start, self.end = np.log(table[1]), np.log(table[2])
            self.onward = np.log(pairs / pairs.sum(axis=1, keepdims=True)).ravel()
            self.backward = np.log(pairs / pairs.sum(axis=0, keepdims=True)).ravel()

    def prefix(self, grams: np.ndarray, size: int) -> tuple[np.ndarray, int]:
        """Places of the ``size`` rarest bigrams (more, until two are disjoint), and the last one's rank."""
        rank = self.rank[grams]
        for last in np.unique(rank)[max(0, len(np.unique(np.sort(rank)[:size])) - 1) :]:
            places = np.flatnonzero(rank <= last)
            if places[-1] - places[0] >= 2:
                break
        return places, int(last)

    def pivots(self, grams: np.ndarray, places: np.ndarray) -> tuple[int, int]:
        """The two disjoint places that the fewest words should share: for the left one the bigrams up
        to it, for the right one those from it. One pass keeps the best left place for each right one."""
        left = np.cumsum(np.append(self.start[grams[0]], self.onward[grams[1:]]))
        right = np.cumsum(np.append(self.end[grams[-1]], self.backward[grams[:-1]][::-1]))[::-1]
        best, pair, i, left_best = np.inf, None, 0, (np.inf, 0)
        for b in places.tolist():
            while places[i] <= b - 2:
                left_best = min(left_best, (float(np.exp(left[places[i]])), int(places[i])))
                i += 1
            if i and (cost := left_best[0] + float(np.exp(right[b]))) < best:
                best, pair = cost, (left_best[1], b)
        return pair


def _key(kind: str, *parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join((kind, *parts)).encode()) - (1 << 63)


def _halves(word: str) -> tuple[list[int], list[int]]:
    """Keys of a word whose partner may be met by an intact half, and of one that may be such a partner."""
    n = len(word)
    own = [_key("left", word[: n // 2]), _key("right", word[n // 2 :])]
    others = {_key("left", word[: m // 2]) for m in (n - 1, n, n + 1)}
    others |= {_key("right", word[n - (m - m // 2) :]) for m in (n - 1, n, n + 1) if m - m // 2 <= n}
    return own, sorted(others)


def word_keys(word: str, order: GramOrder, prefix: int) -> tuple[list[int], list[int], int]:
    """(keys of the pivots, keys of the gram prefix, rank of the prefix's last bigram)."""
    n, own, others, last = len(word), [], [], 0
    if SHORT <= n <= LONG:
        grams = _grams(word)
        places, last = order.prefix(grams, prefix)
        a, b = order.pivots(grams, places)
        head, tail = word[0], word[-1]
        own = [_key("L", word[: a + 2], tail), _key("R", head, word[b:]), _key("E", word[:-1]), _key("S", word[1:])]
        others = [_key("L", word[: p + 2], tail) for p in places.tolist()]
        others += [_key("R", head, word[p:]) for p in places.tolist()]
        others += [_key("E", word[:m]) for m in (n, n - 1, n - 2)] + [_key("S", word[m:]) for m in (0, 1, 2)]
    if n <= SHORT or n >= LONG:
        more, partners = _halves(word)
        own, others = own + more, others + partners
    return own, others, last


def _keyed(order, prefix, pivots, batches):
    for b in batches:
        of, keys, lasts = [], [], []
        for i, word in enumerate(b.column("word").to_pylist()):
            own, others, last = word_keys(word, order.value, prefix)
            found = own if pivots else others
            of += [i] * len(found)
            keys += found
            lasts += [last] * len(found)
        take = pa.array(of, pa.int64())
        columns = [pa.array(keys, pa.int64()), b.column("word").take(take), b.column("n").take(take), pa.array(lasts, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["key", "word", "n", "last"])


def near_words(words: DataFrame, *, prefix: int = PREFIX) -> DataFrame:
    """(word, n, other, other_n) of every two near words of (word, n), in both directions; words are distinct."""
    if prefix < 3:
        raise ValueError("a prefix has 3 bigrams at least")
    spark = words.sparkSession
    counts = words.select("word").mapInArrow(_gram_counts, "gram bigint, n bigint, first bigint, last bigint")
    rows = counts.groupBy("gram").agg(F.sum("n"), F.sum("first"), F.sum("last")).collect()  # 65,536 at most
    words = words.select("word", "n").repartition(max(1, -(-words.count() // TASK_WORDS)))
    order = spark.sparkContext.broadcast(GramOrder(*np.array(rows, np.int64).reshape(-1, 4).T))
    keyed = [
        words.mapInArrow(partial(_keyed, order, prefix, pivots), "key bigint, word string, n bigint, last int")
        for pivots in (True, False)
    ]
    s, r = (k.alias(name) for k, name in zip(keyed, "sr"))
    # short and long words meet by halves whatever their prefixes
    ranked = f"s.last <= r.last OR least(length(s.word), length(r.word)) <= {SHORT} OR greatest(length(s.word), length(r.word)) >= {LONG}"
    met = s.join(
        r,
        F.expr(
            f"s.key = r.key AND abs(length(s.word) - length(r.word)) <= 1 AND ({ranked}) "
            "AND s.word != r.word AND levenshtein(s.word, r.word, 1) = 1"
        ),
    )
    both = met.selectExpr(
        "inline(array(struct(s.word AS word, s.n AS n, r.word AS other, r.n AS other_n),"
        " struct(r.word AS word, r.n AS n, s.word AS other, s.n AS other_n)))"
    )
    return both.dropDuplicates(["word", "other"])


def group_variants(words: DataFrame, *, ratio: int = RATIO, prefix: int = PREFIX) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of (word, n); words are distinct."""
    scratch = Scratch(words.sparkSession)
    words = scratch.write(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    forms = (
        near_words(words, prefix=prefix)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .selectExpr("word", "n_near", f"CASE WHEN -best.less >= {ratio} * n THEN struct(best.form, -best.less AS form_n) END AS best")
        .selectExpr("word", "n_near", "best.form", "best.form_n")
    )
    forms = scratch.write(forms, "forms")
    released(scratch)
    roots, changed, n = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 1, 0
    while changed:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        n, step = n + 1, scratch.write(step, f"roots-{n + 1}")
        roots, changed = step.select("word", "root"), step.where("moved").count()
        if n > 1:
            released(scratch, f"roots-{n - 1}")
    return (
        words.join(forms, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )

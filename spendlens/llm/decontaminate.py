"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised items (A-Z lower-cased; words are runs of ASCII letters, digits and non-ASCII
characters) go into one automaton over words. Each document's words stream through it once,
tracking the longest match that ends at each word: a match of ``window`` words or more marks a
*window* (``window`` consecutive item words) ending there, and a shorter item, which is one
window by itself, is found on the suffix-link path of the current state. A word inside any
window is *hit*.

Scale: the items are dealt to shards of some ``shard_words`` words (a window never spans items), and tasks build
each shard's automaton and write it to the shared folder. One automaton at a time is read and broadcast: its
size is bounded by ``shard_words``, or by the longest item, however large the benchmark is. With one
shard (a benchmark of up to some 400 KB) the documents are mapped once, without a shuffle. With more, each shard is one
map over the documents that writes the hits of texts that have any, by two hashes of the text; these are
merged and joined back, and the documents are shuffled for that once.

Defined results: a null or empty text has no words and no hits; a null item is no item; items
with equal words are each reported; repeated document rows are judged row by row; very long texts
and items are read whole; an empty benchmark or document table gives no hits or no rows; other columns
may have any name.
"""

from __future__ import annotations

import pickle
import re
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import bounded_batches, carried, map_columns, restored, texts, whole_runs, with_columns, written

#: words of a window
WINDOW = 13
#: words of items in one automaton (some 300 bytes of a worker's memory each)
SHARD_WORDS = 200_000
#: a document is contaminated from one hit word in so many
WORDS_PER_HIT = 20

_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

#: spans of at least so many words are cut from documents that stay
MIN_CUT = WINDOW

_SPANS_SQL = "array<struct<start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def normal_words(text: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text."""
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with what each state says of windows.

    ``items_at[s]``: sequences that contain the ``window``-word suffix of state ``s`` (kept
    for the one state on each link path whose lengths span ``window``); ``short_at[s]``:
    (length, sequence) of whole sequences shorter than ``window`` that state ``s`` holds.
    """

    def __init__(self, sequences: list[list[bytes]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        coded = [[self.vocab.setdefault(w, len(self.vocab)) for w in seq] for seq in sequences]
        for seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self._mark(coded)

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the strings that reach it by ``c`` from ``p`` and its links."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier sequence has this prefix
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _mark(self, coded: list[list[int]]) -> None:
        n, w = len(self.next), self.window
        order = sorted(range(n), key=self.length.__getitem__)
        #: the state of the window-word suffix, for states that hold one
        self.window_state = [-1] * n
        for s in order[1:]:
            if self.length[s] >= w:
                up = self.link[s]
                self.window_state[s] = s if self.length[up] < w else self.window_state[up]
        self.items_at: dict[int, set[int]] = {}
        self.short_at: dict[int, list[tuple[int, int]]] = {}
        for k, seq in enumerate(coded):
            s = 0
            for i, c in enumerate(seq):
                s = self.next[s][c]
                if i + 1 >= w:
                    self.items_at.setdefault(self.window_state[s], set()).add(k)
            if 0 < len(seq) < w:
                self.short_at.setdefault(s, []).append((len(seq), k))
        #: the nearest state on the link path, itself included, that holds a short sequence
        self.short_state = [-1] * n
        for s in order:
            self.short_state[s] = s if s in self.short_at else self.short_state[self.link[s]] if s else -1
        self.least = min([w, *(len(s) for s in coded if s)])

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Merged word spans [start, end) of all windows in ``words``; the sequences they are of."""
        spans: list[list[int]] = []
        found: set[int] = set()
        if len(words) < self.least:
            return spans, found
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        # a word no item has ends every match: stream only runs long enough for a window
        cuts = np.flatnonzero(ids < 0)
        starts = np.concatenate(([0], cuts + 1))
        ends = np.append(cuts, len(ids))
        for a, b in zip(*(x[ends - starts >= self.least].tolist() for x in (starts, ends))):
            self._stream(ids[a:b].tolist(), a, spans, found)
        return spans, found

    def _stream(self, ids: list[int], base: int, spans: list[list[int]], found: set[int]) -> None:
        nxt, link, length, window = self.next, self.link, self.length, self.window
        s = matched = 0
        for i, c in enumerate(ids, base):
            while s and c not in nxt[s]:
                s = link[s]
                matched = length[s]
            t = nxt[s].get(c)
            if t is None:
                s = matched = 0
                continue
            s = t
            matched += 1
            longest = 0
            if matched >= window:
                longest = window
                found |= self.items_at[self.window_state[s]]
            u = self.short_state[s]
            while u > 0:
                for n, k in self.short_at[u]:
                    if n <= matched:
                        found.add(k)
                        longest = max(longest, n)
                u = self.short_state[link[u]]
            if longest:
                start = i + 1 - longest
                # a longer window may reach back over spans that shorter ones have made
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])


#: bytes of an automaton in one row
_PART_BYTES = 4 << 20


def _build(window, batches):
    """(shard, part, bytes) of each shard's automaton and the item ids of each of its sequences."""
    for rows, starts in whole_runs(batches, "shard"):
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows]):
            own = rows.slice(a, z - a).to_pydict()
            ids: dict[tuple[bytes, ...], list[str]] = {}
            for item, text in zip(own["item"], own["text"]):
                if seq := tuple(normal_words(text)):
                    ids.setdefault(seq, []).append(item)
            if not ids:
                continue
            order = sorted(ids)
            made = (SuffixAutomaton([list(s) for s in order], window), [sorted(ids[s], key=str) for s in order])
            packed = zlib.compress(pickle.dumps(made, pickle.HIGHEST_PROTOCOL), 1)
            for k, at in enumerate(range(0, len(packed), _PART_BYTES)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own["shard"][0]]), pa.array([k], pa.int32()), pa.array([packed[at : at + _PART_BYTES]], pa.binary())],
                    ["shard", "part", "bytes"],
                )


class Shards:
    """The automata of a benchmark, in the shared folder."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, window: int, shard_words: int):
        bounded_batches(benchmark.sparkSession)
        items = benchmark.where(F.col(f"`{text_col}`").isNotNull()).select(
            F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("binary").alias("text")
        )
        # a word takes at least two bytes with its separator
        size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        n = max(1, -(-size // (2 * shard_words)))
        dealt = items.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(n))).repartition("shard").sortWithinPartitions("shard")
        self.parts = written(dealt.mapInArrow(partial(_build, window), "shard bigint, part int, bytes binary"), "automata")
        #: shards that have an item
        self.numbers = sorted(r["shard"] for r in self.parts.select("shard").distinct().collect())

    def load(self, k: int) -> tuple:
        """The automaton of a shard, and its sequences' item ids."""
        parts = self.parts.where(F.col("shard") == k).orderBy("part").collect()
        return pickle.loads(zlib.decompress(b"".join(bytes(p["bytes"]) for p in parts)))


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _scanner(shared, batches):
    automaton, item_ids = shared.value or (None, None)
    for b in batches:
        n_words, out_spans, out_items = [], [], []
        for t, old, named in zip(*(b.column(c).to_pylist() for c in ("_text", "spans", "items"))):
            words = normal_words(t)
            new, found = automaton.scan(words) if automaton else ([], ())
            n_words.append(len(words))
            spans = _merged([*([x["start"], x["end"]] for x in old), *new]) if old else new
            out_spans.append([{"start": x, "end": y} for x, y in spans])
            out_items.append((named or []) + [x for k in found for x in item_ids[k] if x is not None])
        yield with_columns(
            b,
            n_words=pa.array(n_words, pa.int64()),
            spans=pa.array(out_spans, _SPANS),
            items=pa.array(out_items, pa.list_(pa.string())),
        )


def _report(shared, batches):
    for b in _scanner(shared, batches):
        yield with_columns(b, ("_text",))


def _hits(shared, batches):
    """(_key, _key2, spans, items) of the texts that a shard has a window of."""
    for b in _scanner(shared, batches):
        some = pa.array([i for i, found in enumerate(b.column("spans").to_pylist()) if found], pa.int64())
        yield b.take(some).select(["_key", "_key2", "spans", "items"])


def _scanned(base: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, shard_words: int, run, **added):
    """``base`` (with _text) mapped by ``run`` (given the one shard, or none where the hits are known, and the
    batches, with spans and items to add to); its result has the other columns of ``base`` and those added."""
    spark = base.sparkSession
    shards = Shards(benchmark, item_col, item_text_col, window, shard_words)
    if len(shards.numbers) <= 1:
        known = base.withColumns({"spans": F.lit(None).cast(_SPANS_SQL), "items": F.lit(None).cast("array<string>")})
        shared = spark.sparkContext.broadcast(shards.load(shards.numbers[0]) if shards.numbers else None)
        return map_columns(known, partial(run, shared), ("_text", "spans", "items"), **added)
    scratch = Scratch(spark)
    keys = {"_key": F.xxhash64("_text"), "_key2": F.xxhash64(F.lit(1), "_text")}
    texts_ = base.select("_text").withColumns(keys | {"spans": F.lit(None).cast(_SPANS_SQL), "items": F.lit(None).cast("array<string>")})
    kinds = f"_key bigint, _key2 bigint, spans {_SPANS_SQL}, items array<string>"
    paths = []
    for k in shards.numbers:
        shared = spark.sparkContext.broadcast(shards.load(k))
        scratch.write(texts_.mapInArrow(partial(_hits, shared), kinds).dropDuplicates(["_key", "_key2"]), f"hits-{k}")
        paths.append(scratch.path(f"hits-{k}"))
        shared.destroy()
    hits = spark.read.schema(kinds).parquet(*paths).groupBy("_key", "_key2").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    known = base.withColumns(keys).join(hits, ["_key", "_key2"], "left").drop("_key", "_key2")
    return map_columns(known, partial(run, spark.sparkContext.broadcast(None)), ("_text", "spans", "items"), **added)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    words_per_hit: int = WORDS_PER_HIT,
) -> DataFrame:
    """Per document row: id, n_words, n_hit, spans, items, contaminated.

    ``spans`` are merged word ranges [start, end) of all windows, ``items`` the ids of the items
    that have a window in the document, sorted as strings. ``contaminated``: some word is hit,
    and at least one word in ``words_per_hit`` is.
    """
    base = texts(docs, id_col, text_col, binary=True)
    found = _scanned(
        base, benchmark, item_col, item_text_col, window, shard_words, _report,
        n_words="bigint", spans=_SPANS_SQL, items="array<string>",
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_hit",
        "spans",
        F.sort_array(F.array_distinct("items")).alias("items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * words_per_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _clean(words_per_hit, least, shared, batches):
    """The rows that are not contaminated, long spans cut."""
    for b in _scanner(shared, batches):
        take, out = [], []
        columns = (b.column(c).to_pylist() for c in ("_text", "n_words", "spans"))
        for i, (t, n, spans) in enumerate(zip(*columns)):
            hit = sum(s["end"] - s["start"] for s in spans)
            if hit == 0 or hit * words_per_hit < n:
                long_ = [(s["start"], s["end"]) for s in spans if s["end"] - s["start"] >= least]
                take.append(i)
                out.append(cut_words(t, long_) if long_ else t)
        kept = b.take(pa.array(take, pa.int64()))
        yield with_columns(kept, ("n_words", "spans", "items"), _text=pa.array(out, pa.binary()))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    length_col: str | None = None,
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    words_per_hit: int = WORDS_PER_HIT,
    min_cut: int = MIN_CUT,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, spans of ``min_cut`` words or more cut out
    of their texts (a text without such a span stays as it is; null becomes empty)."""
    base = carried(docs, text_col, binary=True)
    run = partial(_clean, words_per_hit, min_cut)
    clean = _scanned(base, benchmark, item_col, item_text_col, window, shard_words, run, _text="binary")
    return restored(clean, docs, text_col, F.decode("_text", "UTF-8"), length_col)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans; what stands between kept words stays."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, text[last:]])

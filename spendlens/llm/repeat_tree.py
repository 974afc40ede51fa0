"""Exact substring deduplication over bytes by the common-prefix interval tree of a suffix array.

A byte is removed if some ``length``-byte string that covers it also starts earlier: in a document
with a smaller id, or in the same document at an earlier byte. Strings are judged on the input and
never cross documents.

1. *Pieces.* Of the ``gram``-byte runs inside a ``length``-byte window the one with the lowest hash
   (the leftmost of equals) is its anchor. Neighbouring windows with one anchor make a *piece*, some
   140 bytes. Equal windows have equal anchors in the same place, so the suffix array falls apart
   exactly: suffixes that share ``length`` bytes lie in pieces of one anchor gram (a *bucket*).
   Grams that occur once are counted out in Spark first (partial aggregates); only pieces of the
   others are cut from the texts, and equal pieces are one from there on, known by their first place.
2. *Suffix array.* Buckets go to tasks whole. There the suffixes of their pieces are sorted with
   their common prefixes; a stack scan builds the interval tree, bottom up. An interval of at
   least ``length`` common bytes is a maximal repeat if its suffixes are preceded by different bytes
   (or one of them starts its piece): all of the interval's suffixes are its occurrences. An
   interval without left diversity is part of the one that starts a byte earlier.
3. *Removal.* Of each interval every occurrence but the first goes; what an occurrence loses is
   decided in the deepest interval where it is not the first, that is its longest such repeat.

Scale: no step gathers the occurrences of a passage. Repeated pieces are merged by partial
aggregates; a bucket of more than ``bucket`` different pieces (the surroundings of a very frequent
passage) does not go to one task: its intervals are split at ``length`` bytes, and each is counted by
the hash of those bytes, again by partial aggregates. Joins back are by hash and splittable where one
is hot. Documents are cut in blocks, so memory in a task is bounded by a document and its rows.
Steps are written to the shared folder and deleted as soon as no later step reads them.

Defined results: a null or empty text has no bytes; a null id counts as larger than any other, rows
that share an id but not the text are ordered by two hashes of their texts; rows that repeat id and
text are one document and lose the same; texts of under ``length`` bytes stay whole. Repeats
longer than a piece come from ``repeat_groups`` as overlapping groups, one a piece; of a hot bucket
they come as strings of ``length`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import mix64, released, texts, whole_runs
from .substring_dedup import RollingHash, sliding_min

LENGTH = 100
GRAM = 24
#: different pieces of a bucket that one task sorts: some 1.1 MB of text with 300,000 suffixes, which take 120 MB
BUCKET = 8_192
#: window starts handled at once, and pieces of small buckets sorted at once
_BLOCK = 1 << 18
_CHUNK = 512
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_PLACE = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15

#: a place: a document by its number, which grows with the order of documents, and a byte of it
_PLACE_TYPE = "struct<doc:bigint,at:int>"
_DOC = ("_id", "_key", "_key2")


class _Cutter:
    """Pieces of a text."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram, self.rolling = length, min(gram, length), RollingHash(_BASE)

    def pieces(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """(start, end, place of the anchor, its gram's hash) of the pieces, block by block."""
        for i in range(0, len(text) - self.length + 1, _BLOCK):
            block = np.frombuffer(text, np.uint8, min(_BLOCK + self.length - 1, len(text) - i), i)
            h = mix64(self.rolling.runs(self.rolling.prefix(_BYTE[block]), self.gram))
            placed = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
            at = (sliding_min(placed, self.length - self.gram + 1) & _PLACE).astype(np.int64)
            cut = np.flatnonzero(at[1:] != at[:-1]) + 1
            first, last = np.concatenate(([0], cut)), np.append(cut, len(at)) - 1
            yield first + i, last + i + self.length, at[first] + i, h[at[first]].view(np.int64)


def _anchors(length, gram, batches):
    """Gram hashes of a document's anchors; twice where they have more than one place."""
    cutter = _Cutter(length, gram)
    for b in batches:
        of, found = [], []
        for i, text in enumerate(b.column("_text").to_pylist()):
            if len(text) >= length:
                grams, n = np.unique(np.concatenate([p[3] for p in cutter.pieces(text)]), return_counts=True)
                found.append(np.concatenate((grams, grams[n > 1])))
                of.append(i)
        if of:
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(of)) for c in _DOC), lists], [*_DOC, "grams"])


def _cut_pieces(length, gram, batches):
    """A row for each different piece of a document whose gram is wanted, with all its starts."""
    cutter = _Cutter(length, gram)
    for b in batches:
        out = {k: [] for k in ("of", "gram", "c1", "c2", "piece", "starts")}
        for i, (text, wanted) in enumerate(zip(b.column("_text").to_pylist(), b.column("wanted"))):
            wanted, seen = np.asarray(wanted.values), {}
            for start, end, _, grams in cutter.pieces(text):
                keep = np.flatnonzero(np.isin(grams, wanted))
                for s, e, g in zip(start[keep].tolist(), end[keep].tolist(), grams[keep].tolist()):
                    if (known := seen.get(text[s:e])) is None:
                        seen[text[s:e]] = (g, [s])
                    else:
                        known[1].append(s)
            for piece, (g, starts) in seen.items():
                wide = xxhash.xxh3_128_intdigest(piece)
                row = (i, g, (wide >> 64) - (1 << 63), (wide & (1 << 64) - 1) - (1 << 63), piece, starts)
                for column, value in zip(out.values(), row):
                    column.append(value)
        take = pa.array(out.pop("of"), pa.int64())
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
        arrays = [b.column("doc").take(take), *(pa.array(v, kind) for v, kind in zip(out.values(), kinds))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc", *out])


class SuffixArray:
    """The suffixes of at least ``length`` bytes of some pieces, sorted, with common prefixes.

    Suffixes whose first ``length`` bytes no other one has cannot be in a repeat and are left out.
    """

    def __init__(self, pieces: list[bytes], length: int, rolling: RollingHash):
        self.length = length
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        base = np.cumsum(size) - size
        self.text = text = np.frombuffer(b"".join(pieces) + bytes(int(size.max())), np.uint8)
        n = size - length + 1
        piece = np.repeat(np.arange(len(pieces)), n)
        start = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        head = rolling.runs(rolling.prefix(_BYTE[text]), length)[base[piece] + start]
        order = np.argsort(head)
        twin = head[order][1:] == head[order][:-1]
        keep = order[np.append(twin, False) | np.insert(twin, 0, False)]
        piece, start = piece[keep], start[keep]
        left = size[piece] - start
        at = base[piece] + start
        width = int(left.max()) if len(left) else 1
        # padded with zeros: a shorter suffix sorts before a longer one that goes on with zeros
        order = np.argsort(left, kind="stable")
        piece, start, left, at = piece[order], start[order], left[order], at[order]
        rows = np.lib.stride_tricks.sliding_window_view(text, width)[at]
        for i in range(0, len(rows), 4_096):
            rows[i : i + 4_096][np.arange(width) >= left[i : i + 4_096, None]] = 0
        order = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
        self.piece, self.start, rows, left = piece[order], start[order], rows[order], left[order]
        common = np.zeros(len(order) + 1, np.int64)
        for i in range(1, len(order), 4_096):  # a few rows at a time: the comparison is as wide as they are
            same = rows[i : i + 4_096] == rows[i - 1 : i - 1 + len(rows[i : i + 4_096])]
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            common[i : i + len(run)] = run
        common[1:-1] = np.minimum(common[1:-1], np.minimum(left[1:], left[:-1]))
        #: common[i]: bytes that suffix i shares with the one before it
        self.common = common
        before = text[np.maximum(base[self.piece] + self.start - 1, 0)].astype(np.int64)
        #: the byte before a suffix; -1 where its piece starts
        self.before = np.where(self.start > 0, before, -1)


def maximal_repeats(array: SuffixArray, rank: np.ndarray) -> Iterator[tuple[int, int, int, list[int]]]:
    """(low, high, length, beaten) of each left-diverse interval [low, high) of common prefixes.

    A stack scan from left to right closes an interval when a shorter common prefix follows.
    ``rank`` orders the suffixes by their place in the corpus. ``beaten`` has the suffixes that are
    the first of what they come from (a deeper interval, or themselves) but not of this one.
    """
    shortest, common, before, rank = array.length, array.common.tolist(), array.before.tolist(), rank.tolist()
    stack: list[list] = []  # [length, low, first, byte before or -1 for different ones, beaten]
    for i in range(len(rank)):
        low, first, byte = i, i, before[i]
        shared = common[i + 1]
        while True:
            if stack and stack[-1][0] > shared:  # the interval on top ends with this member
                length, low, winner, other, beaten = stack.pop()
                beaten.append(max(winner, first, key=rank.__getitem__))
                first = min(winner, first, key=rank.__getitem__)
                byte = byte if byte == other else -1
                if byte < 0:
                    yield low, i + 1, length, beaten
            elif stack and stack[-1][0] == shared:
                top = stack[-1]
                top[4].append(max(top[2], first, key=rank.__getitem__))
                top[2] = min(top[2], first, key=rank.__getitem__)
                top[3] = byte if byte == top[3] else -1
                break
            else:
                if shared >= shortest:
                    stack.append([shared, low, first, byte, []])
                break


def _trees(length, listed, batches):
    """Of each piece the spans that its first place loses, or, if ``listed``, of each repeat its
    occurrences in pieces."""
    rolling = RollingHash(_BASE)
    for rows, _ in whole_runs(batches, "gram", least=_CHUNK):
        b = rows.to_pydict()
        array = SuffixArray(b["piece"], length, rolling)
        doc = np.unique([f["doc"] for f in b["first"]], return_inverse=True)[1]
        at = np.array([f["at"] for f in b["first"]], np.int64)
        rank = (doc[array.piece] << 32) + at[array.piece] + array.start
        piece, start = array.piece.tolist(), array.start.tolist()
        if listed:
            out = {k: [] for k in ("c1", "c2", "start", "length", "repeat")}
            for low, high, size, _ in maximal_repeats(array, rank):
                name = xxhash.xxh3_128_hexdigest(b["piece"][piece[low]][start[low] : start[low] + size])
                for i in range(low, high):
                    for column, v in zip(out.values(), (b["c1"][piece[i]], b["c2"][piece[i]], start[i], size, name)):
                        column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))
            continue
        lost: dict[int, list] = {}
        for _, _, size, beaten in maximal_repeats(array, rank):
            for i in beaten:
                lost.setdefault(piece[i], []).append((start[i], start[i] + size))
        spans = [[{"start": a, "end": z} for a, z in merged(v)] for v in lost.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([b["c1"][i] for i in lost], pa.int64()),
                pa.array([b["c2"][i] for i in lost], pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            ["c1", "c2", "spans"],
        )


def _strings(length, batches):
    """Every string of ``length`` bytes of a piece, as two hashes."""
    for b in batches:
        of, start, h1, h2 = [], [], [], []
        for i, piece in enumerate(b.column("piece").to_pylist()):
            for s in range(len(piece) - length + 1):
                wide = xxhash.xxh3_128_intdigest(piece[s : s + length])
                of.append(i)
                start.append(s)
                h1.append((wide >> 64) - (1 << 63))
                h2.append((wide & (1 << 64) - 1) - (1 << 63))
        kept = [b.column(c).take(pa.array(of, pa.int64())) for c in ("c1", "c2", "first")]
        added = [pa.array(start, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())]
        yield pa.RecordBatch.from_arrays([*kept, *added], ["c1", "c2", "first", "start", "h1", "h2"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal intervals that the given ones cover."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _cut(batches):
    for b in batches:
        size, spans, kept = [], [], []
        for text, gone, copy in zip(b.column("_text").to_pylist(), b.column("gone").to_pylist(), b.column("copy").to_pylist()):
            own = [(0, len(text))] if copy else merged([(s["start"], s["end"]) for s in gone or ()])
            size.append(len(text))
            spans.append([{"start": a, "end": z} for a, z in own])
            ends = [0, *(z for _, z in own)]
            kept.append(b"".join(text[a:z] for a, z in zip(ends, [*(a for a, _ in own), len(text)])))
        yield pa.RecordBatch.from_arrays(
            [
                b.column("_id"),
                pa.array(size, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            ["_id", "n_bytes", "spans", "kept"],
        )


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["_id"].eqNullSafe(b["_id"]) & (a["_key"] == b["_key"]) & (a["_key2"] == b["_key2"])


class _Run:
    """The relations of one run, in a scratch folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, bucket: int):
        if not 1 <= gram <= length < _BLOCK:
            raise ValueError("gram <= length is needed")
        self.length, self.bucket = length, bucket
        self.base = base = (
            texts(docs, id_col, text_col, binary=True)
            .withColumn("_key", F.xxhash64("_text"))
            .withColumn("_key2", F.xxhash64(F.lit(1), "_text"))
        )
        self.id_type = base.schema["_id"].dataType.simpleString()
        self.scratch = scratch = Scratch(docs.sparkSession)

        kind = f"_id {self.id_type}, _key bigint, _key2 bigint, grams array<bigint>"
        signed = scratch.write(base.mapInArrow(partial(_anchors, length, gram), kind), "signed")
        # equal texts: the first of them stands for all, and the others go
        rows = signed.select(*_DOC).distinct()
        first = rows.groupBy("_key", "_key2").agg(F.min("_id").alias("first"))
        later = (F.col("first") < F.col("_id")) | (F.col("_id").isNull() & F.col("first").isNotNull())
        rows = scratch.write(rows.join(first, ["_key", "_key2"]).select(*_DOC, F.coalesce(later, F.lit(False)).alias("copy")), "rows")
        self.copies = rows.where("copy").select(*_DOC)
        # numbers that grow with the order of documents: the range partition, then the place in it
        order = (F.col("_id").isNull().alias("no_id"), "_id", "_key", "_key2")
        ordered = rows.where("NOT copy").repartitionByRange(*order).sortWithinPartitions(*order)
        self.docs = docs = scratch.write(ordered.select(*_DOC, F.monotonically_increasing_id().alias("doc")), "docs")
        marked = scratch.write(signed.join(docs, _same(signed, docs)).select("doc", "grams"), "marked")
        released(scratch, "signed")
        grams = marked.select("doc", F.explode("grams").alias("gram"))
        shared = scratch.write(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "shared")
        released(scratch)
        wanted = grams.join(shared, "gram").groupBy("doc").agg(F.collect_set("gram").alias("wanted"))
        wanted = scratch.write(wanted.join(docs, "doc"), "wanted")
        released(scratch, "marked", "shared")
        #: (doc, gram, c1, c2, piece, starts): the pieces that may have a part elsewhere
        self.pieces = scratch.write(
            base.join(wanted, _same(base, wanted))
            .select("doc", "_text", "wanted")
            .mapInArrow(
                partial(_cut_pieces, length, gram),
                "doc bigint, gram bigint, c1 bigint, c2 bigint, piece binary, starts array<int>",
            ),
            "pieces",
        )
        released(scratch, "wanted")
        place = F.struct("doc", F.col("starts")[0].alias("at"))
        #: different pieces: their first place and how often they occur
        self.distinct = scratch.write(
            self.pieces.groupBy("c1", "c2").agg(
                F.min(place).alias("first"), F.sum(F.size("starts")).alias("n"), F.first("gram").alias("gram"), F.first("piece").alias("piece")
            ),
            "distinct",
        )
        released(scratch)
        sizes = self.distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        self.sized = self.distinct.join(sizes, "gram").select("gram", "c1", "c2", "first", "piece", "size")

    def trees(self, listed: bool) -> DataFrame:
        """The buckets that fit a task, through their interval trees."""
        out = "start int, length int, repeat string" if listed else "spans array<struct<start:int,end:int>>"
        return (
            self.sized.where(F.col("size") <= self.bucket)
            .drop("size")
            .repartition("gram")
            .sortWithinPartitions("gram")
            .mapInArrow(partial(_trees, self.length, listed), f"c1 bigint, c2 bigint, {out}")
        )

    def split(self) -> tuple[DataFrame, DataFrame]:
        """Of the larger buckets: their strings, and those strings' first places."""
        hot = self.sized.where(F.col("size") > self.bucket).select("c1", "c2", "first", "piece")
        strings = hot.mapInArrow(
            partial(_strings, self.length), f"c1 bigint, c2 bigint, first {_PLACE_TYPE}, start int, h1 bigint, h2 bigint"
        ).withColumn("first", F.col("first").withField("at", F.col("first.at") + F.col("start")))
        strings = self.scratch.write(strings, "strings")
        owners = strings.groupBy("h1", "h2").agg(F.min("first").alias("owner"), F.count(F.lit(1)).alias("m")).where("m > 1")
        return strings, owners


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    bucket: int = BUCKET,
) -> DataFrame:
    """Per document row: id, n_bytes, spans (maximal removed byte runs [start, end)) and kept (the
    other bytes)."""
    run = _Run(docs, id_col, text_col, length, gram, bucket)
    scratch, base = run.scratch, run.base
    strings, owners = run.split()
    own = F.struct(F.col("start"), (F.col("start") + length).alias("end"))
    beaten = strings.join(owners, ["h1", "h2"]).where("first != owner")
    lost = run.trees(listed=False).union(beaten.groupBy("c1", "c2").agg(F.collect_list(own)))
    lost = scratch.write(lost, "lost")
    released(scratch, "strings")
    repeated = (
        run.distinct.select("c1", "c2", "first", "n", F.length("piece").alias("size"))
        .join(lost, ["c1", "c2"], "left")
        .where("n > 1 OR spans IS NOT NULL")
    )
    # every place of a repeated piece goes but the first, which loses what lies elsewhere still earlier
    gone = run.pieces.select("doc", "c1", "c2", "starts").join(repeated, ["c1", "c2"]).selectExpr(
        "doc",
        """concat(
            transform(filter(starts, s -> doc != first.doc OR s != first.at), s -> struct(s AS start, s + size AS end)),
            CASE WHEN doc = first.doc AND spans IS NOT NULL
                 THEN transform(spans, p -> struct(first.at + p.start AS start, first.at + p.end AS end)) ELSE array() END) AS gone""",
    )
    gone = gone.where("size(gone) > 0").groupBy("doc").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    removed = gone.join(run.docs, "doc").select(*_DOC, "gone", F.lit(False).alias("copy")).union(
        run.copies.select("*", F.array().cast("array<struct<start:int,end:int>>"), F.lit(True))
    )
    removed = scratch.write(removed, "removed")
    released(scratch, "pieces", "distinct", "lost", "docs", "rows")
    return (
        base.join(removed, _same(base, removed), "left")
        .select(base["_id"], "_text", "gone", "copy")
        .mapInArrow(_cut, f"_id {run.id_type}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
        .withColumnRenamed("_id", id_col)
    )


def repeat_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    bucket: int = BUCKET,
) -> DataFrame:
    """(repeat, length, id, start): all occurrences of the maximal repeats of at least ``length``
    bytes, but those in texts equal to one with a smaller id, which repeat it whole."""
    run = _Run(docs, id_col, text_col, length, gram, bucket)
    strings, owners = run.split()
    parts = run.trees(listed=True).unionByName(
        strings.join(owners, ["h1", "h2"]).selectExpr("c1", "c2", "start", f"{length} AS length", "concat(hex(h1), hex(h2)) AS repeat")
    )
    whole = run.distinct.where("n > 1").selectExpr(
        "c1", "c2", "0 AS start", "length(piece) AS length", "concat(hex(c1), hex(c2)) AS repeat"
    )
    found = run.pieces.select("doc", "c1", "c2", "starts").join(parts.unionByName(whole), ["c1", "c2"]).join(run.docs, "doc")
    return found.select(
        "repeat",
        F.col("length").cast("long"),
        F.col("_id").alias(id_col),
        F.explode(F.transform("starts", lambda s: (s + F.col("start")).cast("long"))).alias("start_byte"),
    ).withColumnRenamed("start_byte", "start")

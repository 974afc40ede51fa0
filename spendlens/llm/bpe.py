"""Byte-level BPE encoding and decoding, each merge found by a segment tree.

A text is split by the tokenizer's pattern. A piece that is a token is that token; any other
piece is merged pair by pair, always the pair of lowest rank and, of equal ranks, the leftmost.
A segment tree over the piece's byte positions stores, for every node, the lowest rank of a
live pair that starts under it. Descending from the root towards the left on ties finds the
leftmost minimum; a merge changes the pairs of at most three live neighbours, each by one
logarithmic point update, so a piece of n bytes costs O(n log n) however long it is.

Scale: two maps, no shuffle. The rank table is read on the driver and broadcast; its size is
that of the vocabulary file, whatever the documents are. Workers remember the ids of at most
2 ``MEMO`` short pieces, from one task to the next. Texts without characters beyond U+FFFF, where
that is possible, are split by the standard library's ``re`` with the pattern's classes spelled out.

Defined results: a null text encodes as the empty text (no ids, empty bytes); repeated rows
are encoded row by row; any text decodes to exactly its own bytes.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, texts

#: pieces a worker remembers, and the longest it remembers (characters)
MEMO = 400_000
MEMO_LENGTH = 64

_NONE = 1 << 60
#: what \s is in the tokenizer's regular expressions: Unicode's White_Space characters
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank (which is the token's id) of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def compile_pattern(pattern: str) -> regex.Pattern:
    """The splitting pattern, with \\s and \\S spelled out as Unicode's White_Space."""
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_WHITE}\p{{L}}\p{{N}}]")
    return regex.compile(inside.replace(r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]"))


@lru_cache(maxsize=8)
def _members(kind: str) -> str:
    """The characters up to U+FFFF of a class, as ranges of a set. Surrogates are in no text."""
    match, found, first = regex.compile(kind).match, [], None
    for c in range(0x10001):
        if c < 0x10000 and not 0xD800 <= c < 0xE000 and match(chr(c)):
            first = c if first is None else first
        elif first is not None:
            found.append(rf"\u{first:04x}-\u{c - 1:04x}")
            first = None
    return "".join(found)


def spell_out(pattern: str) -> re.Pattern | None:
    """The pattern for ``re``, equal to ``compile_pattern``'s on texts without characters beyond U+FFFF; none if it has
    more than plain characters, sets, \\s, \\S, \\p{L}, \\p{N} and groups or lookaheads."""
    if re.search(r"\(\?(?![:!=])|\[\^?\]|&&|--|\|\||~~", pattern):
        return None
    out, inside = [], False
    for token in re.findall(r"\\p\{[LN]\}|\\.|.", pattern, re.S):
        if token in (r"\s", r"\p{L}", r"\p{N}"):
            members = _WHITE if token == r"\s" else _members(token)
            token = members if inside else f"[{members}]"
        elif token == r"\S" and not inside:
            token = f"[^{_WHITE}]"
        elif token[0] == "\\" or token == "[" and inside:
            return None
        elif token in "[]":
            inside = token == "["
        out.append(token)
    return re.compile("".join(out))


@lru_cache(maxsize=8)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Text -> its pieces."""
    general, spelled = compile_pattern(pattern).findall, spell_out(pattern)
    if spelled is None:
        return general
    plain = spelled.findall

    def split(text: str) -> list[str]:
        narrow = text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text)
        return plain(text) if narrow else general(text)

    return split


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece by rank-ordered merging over a segment tree."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get = ranks.get
    width = 1 << (n - 1).bit_length()
    #: node k has the children 2 k and 2 k + 1; the leaf of position i is width + i
    tree = [_NONE] * (2 * width)
    tree[width : width + n - 1] = [get(piece[i : i + 2], _NONE) for i in range(n - 1)]
    for k in range(width + n - 2 >> 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    #: the live part that starts at i ends at end[i]; the one before it starts at before[i]
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def update(i: int, rank: int) -> None:
        k = width + i
        tree[k] = rank
        while k > 1:
            other = tree[k ^ 1]
            if other < rank:
                rank = other
            k >>= 1
            if tree[k] == rank:
                return
            tree[k] = rank

    while (low := tree[1]) != _NONE:
        k = 1
        while k < width:
            k += k
            if tree[k] != low:
                k += 1
        i = k - width
        j = end[i]  # the right part of the pair: it dies
        end[i] = stop = end[j]
        update(j, _NONE)
        if stop < n:
            before[stop] = i
            update(i, get(piece[i : end[stop]], _NONE))
        else:
            update(i, _NONE)
        if (p := before[i]) >= 0:
            update(p, get(piece[p:stop], _NONE))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers.

    Remembers at most twice ``MEMO`` short pieces: when that many are new, they become the old
    generation, and what is not used again in the next one goes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, pattern
        self.old: dict[str, bytes] = {}
        self.split = splitter(pattern)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            found = merge_piece(piece.encode(), self.ranks)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))


#: the last encoder of a worker process, which later tasks of the same vocabulary go on with
_LAST: list[Encoder] = []


def kept_encoder(ranks: dict[bytes, int], pattern: str) -> Encoder:
    """The worker's encoder for this very rank table and pattern, or a new one in its place."""
    if not _LAST or _LAST[0].ranks is not ranks or _LAST[0].pattern != pattern:
        _LAST[:] = [Encoder(ranks, pattern)]
    return _LAST[0]


def _encode(shared, pattern, batches):
    encoder = kept_encoder(shared.value, pattern)
    for b in batches:
        ids = [encoder.encode(t) for t in b.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
            ["_id", "n_tokens", "token_ids"],
        )


def _decode(shared, batches):
    tokens: list[bytes] = [b""] * (1 + max(shared.value.values()))
    for token, rank in shared.value.items():
        tokens[rank] = token
    for b in batches:
        ids = (np.frombuffer(x or b"", "<u4").tolist() for x in b.column("token_ids").to_pylist())
        text = pa.array([b"".join(map(tokens.__getitem__, x)) for x in ids], pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns, text], [*b.schema.names, "decoded"])


def _round_trip(shared, pattern, batches):
    return _decode(shared, _encode(shared, pattern, batches))


def share_ranks(spark: SparkSession, path: str):
    """The rank table as a broadcast variable (its size is the vocabulary file's)."""
    return spark.sparkContext.broadcast(load_ranks(path))


def encode(
    docs: DataFrame, ranks, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Per document row: id, n_tokens, token_ids (little-endian unsigned 32-bit integers).

    ``ranks`` comes from ``share_ranks``; no special tokens are known. ``decoded`` adds what
    ``decode`` would, in the same worker.
    """
    base = texts(docs, id_col, text_col)
    id_type = base.schema["_id"].dataType.simpleString()
    columns = f"_id {id_type}, n_tokens bigint, token_ids binary" + ", decoded binary" * decoded
    out = base.mapInArrow(partial(_round_trip if decoded else _encode, ranks, pattern), columns)
    return out.withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, ranks) -> DataFrame:
    """``encoded`` with ``decoded`` added: the bytes that its token_ids stand for (null: none)."""
    bounded_batches(encoded.sparkSession)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(partial(_decode, ranks), f"{columns}, decoded binary")

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import documents, odd_docs  # noqa: F401

from spendlens.llm import bpe
from spendlens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def judge(ranks):
    return tiktoken.Encoding("judge", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def naive(piece, ranks):
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not pairs or (best := min(pairs))[0] == 1 << 60:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merges_are_leftmost_lowest(ranks):
    rnd = random.Random(1)
    for _ in range(400):
        piece = "".join(rnd.choice("aabthe é¿") for _ in range(rnd.randint(0, 40))).encode()
        assert bpe.merge_piece(piece, ranks) == (naive(piece, ranks) if piece else [])


def test_texts_as_tiktoken(ranks, judge):
    rnd = random.Random(2)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    alphabet = [" ", "  ", "\n", "a", "'s", "!", "1", "é", "\t", "\x1c", "　", "'re", "x", "<|endoftext|>", "😀"]
    texts = ["", "x" * 5000, " " * 500, *("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 20))) for _ in range(3000))]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == judge.encode_ordinary(text), repr(text)


def test_memo_generations(ranks, judge, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 10)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = " ".join(f"wurd{i % 37}" for i in range(300))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == judge.encode_ordinary(text)
    assert len(encoder) <= 10


def test_spelled_out_pattern_splits_alike():
    general, spelled = bpe.compile_pattern(public_tokenizers.PATTERN), bpe.spell_out(public_tokenizers.PATTERN)
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    random.Random(3).shuffle(every)
    for text in (f"a{c} {c}1{c}!" for c in every[::7]):
        assert spelled.findall(text) == general.findall(text), repr(text)
    together = "".join(every)
    assert spelled.findall(together) == general.findall(together)
    split = bpe.splitter(public_tokenizers.PATTERN)
    for text in ("", "a\U0001d400b \U0001f600!", "x \U00010107 1", together + "\U0001d400"):
        assert split(text) == general.findall(text), repr(text)
    # what re may read in another way is left to regex
    for other in (r"(?i:'s)|\w+", r"\P{L}", r"[\r\n]+", r"[\S]", r"(?<=a)b", r"[]a]", r"\d+", r"[a[b]]", r"[\p{L}--a]"):
        assert bpe.spell_out(other) is None


def test_tasks_of_a_worker_share_what_they_merged(ranks, judge, monkeypatch):
    """A piece is merged once a worker, not once a task; another vocabulary or pattern starts anew."""
    from types import SimpleNamespace

    import pyarrow as pa

    merged, merge = [], bpe.merge_piece
    monkeypatch.setattr(bpe, "_LAST", [])
    monkeypatch.setattr(bpe, "merge_piece", lambda piece, r: merged.append(piece) or merge(piece, r))
    batch = pa.RecordBatch.from_pydict({"_id": [1, 2], "_text": ["qwurdle zwixt", "zwixt"]})
    want = [np.array(judge.encode_ordinary(t), "<u4").tobytes() for t in batch.column("_text").to_pylist()]

    def task(shared, pattern=public_tokenizers.PATTERN):
        return [x for b in bpe._encode(shared, pattern, [batch]) for x in b.column("token_ids").to_pylist()]

    shared = SimpleNamespace(value=ranks)
    assert task(shared) == want and len(merged) == 3
    assert task(shared) == want and len(merged) == 3
    assert task(SimpleNamespace(value=dict(ranks))) == want and len(merged) == 6
    task(shared, r"\S+|\s+")
    assert len(bpe._LAST) == 1 and bpe._LAST[0].pattern == r"\S+|\s+"


def test_query_as_tiktoken(spark, documents, judge):
    got = {r.doc_id: r for r in QUERIES["op4_byte_bpe"](spark, "/root/testdata/sf0.01").collect()}
    for d in documents.collect():
        ids = np.array(judge.encode_ordinary(d.text or ""), "<u4").tobytes()
        r = got.pop(d.doc_id)
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert not got


def test_odd_rows(spark, odd_docs):
    shared = bpe.share_ranks(spark, PATH)
    out = bpe.decode(bpe.encode(odd_docs, shared, public_tokenizers.PATTERN), shared).collect()
    want = sorted(((r.doc_id or -1, (r.text or "").encode()) for r in odd_docs.collect()))
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in out) == want
    assert bpe.encode(odd_docs.limit(0), shared, public_tokenizers.PATTERN).count() == 0

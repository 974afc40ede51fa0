from __future__ import annotations

import random

import numpy as np
import pytest
from llm_fixtures import odd_docs  # noqa: F401

from pyspark.sql import functions as F

from spendlens.llm import repeat_tree as R
from spendlens.llm.substring_dedup import RollingHash


def ordered(spark, docs):
    """Bytes of each row and its place in the order the module states."""
    df = spark.createDataFrame(docs, "doc_id long, text string")
    text = F.coalesce("text", F.lit("")).cast("binary")
    keyed = df.select("doc_id", text.alias("t"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    return [((r.doc_id is None, r.doc_id or 0, r.a, r.b), r.doc_id, bytes(r.t)) for r in keyed.collect()]


def brute(rows, length):
    first = {}
    for order, _, t in rows:
        for s in range(len(t) - length + 1):
            x = t[s : s + length]
            first[x] = min(first.get(x, (order, s)), (order, s))
    out = []
    for order, i, t in rows:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if first[t[s : s + length]] < (order, s):
                gone[s : s + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
        out.append((i if i is not None else -1, len(t), [tuple(e) for e in edges.tolist()], bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out)


def removed(spark, docs, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = R.remove_repeats(df, **how).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows)


def mixed(seed):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcé") for _ in range(30)) for _ in range(5)]
    docs = []
    for i in range(60):
        t = ""
        for _ in range(rnd.randint(0, 6)):
            p = rnd.choice(passages)
            t += p[rnd.randint(0, 9) : rnd.randint(15, 30)] if rnd.random() < 0.7 else "".join(rnd.choice("xyz\0") for _ in range(9))
        docs.append((rnd.choice([i, i, i, 3, None]), t))
    docs += [(70, "ab" * 80), (71, "a" * 90), (72, "a" * 91), (73, None), (74, ""), (75, docs[0][1]), (75, docs[0][1]), (None, docs[1][1])]
    return docs + [(80, "\0" * 40), (81, "q" + "\0" * 30)]


@pytest.mark.parametrize("seed,length,gram,bucket", [(1, 12, 4, 1024), (2, 7, 7, 1024), (3, 12, 4, 2), (4, 20, 3, 5)])
def test_random_texts_against_brute_force(spark, seed, length, gram, bucket):
    docs = mixed(seed)
    assert removed(spark, docs, length=length, gram=gram, bucket=bucket) == brute(ordered(spark, docs), length)


def test_blocks_of_long_texts(spark, monkeypatch):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(2_000))
    docs = [(1, long), (2, long[300:900] + "!" + long[100:1500]), (3, long[::-1] + long[10:400] * 2)]
    expected = brute(ordered(spark, docs), 40)
    assert removed(spark, docs, length=40, gram=10) == expected
    size, R._BLOCK = R._BLOCK, 128
    try:  # the cutter itself, in this process
        blocks = [np.concatenate(p) for p in zip(*R._Cutter(40, 10).pieces(long.encode()))]
    finally:
        R._BLOCK = size
    windows = {w for a, z in zip(*blocks[:2]) for w in range(a, z - 39)}
    assert windows == set(range(len(long) - 39)) and sum(z - 39 - a for a, z in zip(*blocks[:2])) == len(windows)


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = R.remove_repeats(odd_docs).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows)
    assert got == brute(ordered(spark, docs), 100)
    assert R.remove_repeats(odd_docs.limit(0)).count() == 0
    assert R.repeat_groups(odd_docs.limit(0)).count() == 0


def test_suffix_array_and_intervals_against_all_substrings():
    rnd = random.Random(6)
    pieces = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(6, 25))) for _ in range(40)]
    array = R.SuffixArray(pieces, 5, RollingHash(R._BASE))
    suffixes = [pieces[p][s:] for p, s in zip(array.piece, array.start)]
    places = {}
    for p, t in enumerate(pieces):
        for s in range(len(t) - 4):
            for e in range(s + 5, len(t) + 1):
                places.setdefault(t[s:e], set()).add((p, s))
    # right-maximal: no single byte follows all; left-diverse: not one byte precedes all
    expected = {}
    for x, where in places.items():
        after = {pieces[p][s + len(x)] if s + len(x) < len(pieces[p]) else (p, s) for p, s in where}
        before = {pieces[p][s - 1] if s else (p,) for p, s in where}
        if len(where) > 1 and len(after) > 1 and (len(before) > 1 or any(s == 0 for _, s in where)):
            expected[x] = where
    got = {}
    for low, high, size, beaten in R.maximal_repeats(array, np.arange(len(suffixes))):
        where = {(int(array.piece[i]), int(array.start[i])) for i in range(low, high)}
        got[suffixes[low][:size]] = where
        assert len({suffixes[i][:size] for i in range(low, high)}) == 1 and set(beaten) <= set(range(low + 1, high))
    assert got == expected


@pytest.mark.parametrize("bucket", [1024, 2])
def test_groups_list_every_occurrence(spark, bucket):
    passage = "It is a passage of some length that several of the documents hold. "
    docs = [(i, f"{chr(97 + i) * 9} {passage}{chr(107 + i) * 9}") for i in range(6)] + [(9, passage * 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = R.repeat_groups(df, length=30, gram=8, bucket=bucket).collect()
    texts = {i: t.encode() for i, t in docs}
    groups = {}
    for r in rows:
        groups.setdefault(r.repeat, set()).add((r.doc_id, r.start, texts[r.doc_id][r.start : r.start + r.length]))
    for where in groups.values():
        (x,) = {w[2] for w in where}
        every = {(i, s, x) for i, t in texts.items() for s in range(len(t)) if t.startswith(x, s)}
        assert where <= every and len(where) > 1
    # the windows of the passage are in groups of eight occurrences
    eight = [w for where in groups.values() if len(where) == 8 for w in where]
    covered = {k for i, s, x in eight if i == 0 for k in range(s, s + len(x))}
    assert covered >= set(range(10, 10 + len(passage)))

from __future__ import annotations

import random

import numpy as np
from llm_fixtures import odd_docs  # noqa: F401

from spendlens.llm import substring_dedup as S


def brute(docs, window):
    """(id, text) -> kept words, by the definition."""
    big = float("inf")
    first = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            first[x] = min(first.get(x, big), big if i is None else i)
    out = []
    for i, t in docs:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (big if i is None else i):
                gone.update(range(k, k + window))
        out.append((i if i is not None else -1, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def removed(spark, docs, window, gram=4):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = S.remove_repeats(df, window=window, gram=gram).collect()
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_words, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in rows
    )


def test_random_texts_against_brute_force(spark):
    rnd = random.Random(9)
    passages = [[f"p{k}_{i}" for i in range(12)] for k in range(4)]
    docs = []
    for i in range(40):
        words = []
        for _ in range(rnd.randint(0, 6)):
            words += rnd.choice(passages)[rnd.randint(0, 4) : rnd.randint(6, 12)] if rnd.random() < 0.6 else [rnd.choice("abc") for _ in range(5)]
        docs.append((rnd.choice([i, i, i, 3, None]), " ".join(words)))
    docs += [(50, "x " * 60), (51, "x  " * 30), (52, "x " * 60), (53, None), (54, ""), (55, " \n ")]
    assert removed(spark, docs, 6) == brute(docs, 6)
    assert removed(spark, docs, 3, gram=3) == brute(docs, 3)


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = S.remove_repeats(odd_docs).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in rows)
    assert got == brute(docs, 50)
    assert S.remove_repeats(odd_docs.limit(0)).count() == 0


def test_rolling_hash_and_sliding_min():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 3, 200).astype(np.uint64)
    rolling = S.RollingHash(S._BASES[0])
    for k in (1, 5, 50):
        got = rolling.runs(rolling.prefix(h), k)
        runs = [tuple(h[i : i + k]) for i in range(len(h) - k + 1)]
        assert len(got) == len(runs)
        assert len(set(got.tolist())) == len(set(runs))
        assert len(set(zip(got.tolist(), runs))) == len(set(runs))
    for k in (1, 2, 3, 35):
        assert S.sliding_min(h, k).tolist() == [h[i : i + k].min() for i in range(len(h) - k + 1)]


def test_merge_windows():
    assert S.merge_windows(np.array([9, 0, 2, 5, 20]), 4) == [(0, 13), (20, 24)]
    assert S.merge_windows(np.array([], int), 4) == []

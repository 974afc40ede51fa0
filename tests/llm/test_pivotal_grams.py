from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import odd_docs  # noqa: F401

from spendlens.llm import pivotal_grams as P


def near(a, b):
    """One inserted, deleted or replaced code point apart, by the definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(docs, least, count, every):
    total = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def brute_groups(counts, ratio):
    form, n_near = {}, {}
    for w, n in counts.items():
        others = sorted((-counts[o], o) for o in counts if near(w, o))
        n_near[w] = len(others)
        form[w] = others[0][1] if others and -others[0][0] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, n_near[w], counts.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def variants(rnd, word, letters):
    i = rnd.randrange(len(word))
    return rnd.choice([word[:i] + word[i + 1 :], word[:i] + rnd.choice(letters) + word[i:], word[:i] + rnd.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("seed,letters,low,high,prefix", [(1, "ab", 4, 9, 3), (2, "abcdeéł", 1, 14, 5), (3, "abcdefgh", 7, 12, 4), (4, "ab", 60, 68, 5)])
def test_near_words_against_all_pairs(spark, seed, letters, low, high, prefix):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in range(120)}
    for _ in range(2):
        words |= {variants(rnd, w, letters) for w in sorted(words)}
    words = sorted(w for w in words if len(w) >= low)
    counts = {w: rnd.randint(1, 9) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = sorted((r.word, r.n, r.other, r.other_n) for r in P.near_words(df, prefix=prefix).collect())
    assert got == sorted((a, counts[a], b, counts[b]) for a in words for b in words if near(a, b))
    assert got


def test_groups_against_brute_force(spark):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abcdefghijklü") for _ in range(9)) for _ in range(25)]
    docs = []
    for i in range(60):
        t = []
        for w in base:
            t += [w] * rnd.choice((0, 9, 30))
            if rnd.random() < 0.4:
                t += [variants(rnd, w, "abz").upper()] * rnd.choice((1, 2))
            if rnd.random() < 0.1:
                t.append(variants(rnd, variants(rnd, w, "ab"), "ab"))
        docs.append((rnd.choice((i, i, None)), "-".join(t) + " Ł× x1y"))
    docs += [(90, None), (91, ""), (92, "k" * 3000), (93, "k" * 3000), (94, "k" * 2999), (95, "k" * 2999)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for every in (None, 5):
        counts = brute_counts(docs, 7, 2, every)
        words = P.count_words(df, drop_every=every)
        assert {r.word: r.n for r in words.collect()} == counts
        expected = brute_groups(counts, 10)
        assert sorted(map(tuple, P.group_variants(words).collect()), key=lambda r: r[0]) == expected
        assert any(r[1] for r in expected)


def test_chains_of_forms_and_ties(spark):
    counts = {"abcdefg": 100_000, "abcdefgh": 10_000, "abcdefghi": 1_000, "abcdefghij": 100, "abcdefghijk": 10, "zbcdefghijk": 1}
    counts |= {"tiedword": 2, "tiedworb": 20, "tiedwora": 20, "tiedworc": 19}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(map(tuple, P.group_variants(df).collect()), key=lambda r: r[0])
    assert got == brute_groups(counts, 10)
    by = {r[0]: r for r in got}
    assert by["zbcdefghijk"][2] == "abcdefg" and by["tiedword"][1] == "tiedwora"


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert {r.word: r.n for r in P.count_words(odd_docs, least_length=2).collect()} == brute_counts(docs, 2, 2, None)
    assert P.group_variants(P.count_words(odd_docs, least_length=1)).count() == len(brute_counts(docs, 1, 2, None))
    assert P.group_variants(P.count_words(odd_docs.limit(0))).count() == 0


def test_pivots_are_the_cheapest_disjoint_pair():
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(4, 12))) for _ in range(80)]
    counts = np.zeros((3, 1 << 16), np.int64)
    for w in words:
        g = P._grams(w)
        np.add.at(counts[0], g, 1)
        counts[1, g[0]] += 1
        counts[2, g[-1]] += 1
    gram = np.flatnonzero(counts[0])
    order = P.GramOrder(gram, *counts[:, gram])
    for w in words:
        g = P._grams(w)
        places, last = order.prefix(g, 3)
        assert set(places) == set(np.flatnonzero(order.rank[g] <= last)) and len(places) >= min(3, len(g))
        left = [np.exp(order.start[g[0]] + sum(order.onward[x] for x in g[1 : a + 1])) for a in range(len(g))]
        right = [np.exp(order.end[g[-1]] + sum(order.backward[x] for x in g[b:-1])) for b in range(len(g))]
        cheapest = min(left[a] + right[b] for a in places for b in places if b - a >= 2)
        a, b = order.pivots(g, places)
        assert b - a >= 2 and {a, b} <= set(places.tolist()) and np.isclose(left[a] + right[b], cheapest)

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
from llm_fixtures import documents, odd_docs  # noqa: F401

from spendlens.llm import near_dedup as N
from spendlens.llm.components import components
from spendlens.llm.decontaminate import normal_words


def grouped(pairs):
    """Smallest member of each node's component."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components(spark):
    rnd = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    noise = [(rnd.randint(1000, 1060), rnd.randint(1000, 1060)) for _ in range(40)]
    links = [*chain, *star, *noise, (7, 7), (-3, 9), (9, -3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = grouped((a, b) for a, b in links if a != b)
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_darts_estimate_weighted_similarity():
    rnd = np.random.default_rng(4)
    elements = rnd.integers(0, 1 << 63, 40).astype(np.uint64)
    for _ in range(3):
        a, b = rnd.choice([0, 0.5, 1, 2.25, 3], (2, 40))
        sig = [N.throw_darts(elements[w > 0], w[w > 0], np.zeros((w > 0).sum(), int), 1, 4000)[0] for w in (a, b)]
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sig[0] == sig[1]).mean() - true) < 0.04


def test_darts_do_not_depend_on_the_batch():
    rnd = np.random.default_rng(6)
    sets = [rnd.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 3, 50, 700)]
    alone = [N.throw_darts(s, np.ones(len(s)), np.zeros(len(s), int), 1, 60)[0] for s in sets]
    doc = np.repeat(np.arange(4), [len(s) for s in sets])
    together = N.throw_darts(np.concatenate(sets), np.ones(len(doc)), doc, 4, 60)
    assert (np.array(alone) == together).all()


def brute_classes(docs, least=0.8):
    sets, by_words = {}, {}
    pairs = [(i, i) for i, _ in docs]
    for i, t in docs:
        w = tuple(normal_words((t or "").encode()))
        if w:
            pairs.append((by_words.setdefault(w, i), i))
            sets[i] = {w[k : k + 5] for k in range(max(1, len(w) - 4))}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for own in holders.values():
        if len(own) < 200:
            for k, a in enumerate(own):
                for b in own[:k]:
                    shared[a, b] += 1
    pairs += [(a, b) for (a, b), n in shared.items() if n >= least * (len(sets[a]) + len(sets[b]) - n)]
    return grouped(pairs)


def test_classes_are_those_of_all_pairs(spark, documents):
    got = {r.doc_id: r.class_id for r in N.near_duplicates(documents).collect()}
    assert got == brute_classes([(r.doc_id, r.text) for r in documents.collect()])


def test_group_of_near_copies_without_a_common_original(spark):
    """Copies of copies: far ends of the chain are unlike, links between neighbours hold it together."""
    rnd = random.Random(8)
    words = [f"w{rnd.randint(0, 10**6)}" for _ in range(200)]
    docs = []
    for i in range(60):
        docs.append((i, " ".join(words)))
        words = list(words)
        words[(i * 37) % 200] = f"new{i}"
    docs += [(1000 + i, " ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(200))) for i in range(40)]
    rnd.shuffle(docs)
    got = {r.doc_id: r.class_id for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id int, text string")).collect()}
    assert got == brute_classes(docs) and {got[i] for i in range(60)} == {0}


def template_pages(n, seed=11):
    """Pages of one template with eight one-word slots: pairs that share three slots are alike."""
    rnd = random.Random(seed)
    words = [f"t{k}" for k in range(271)]
    docs = []
    for i in range(n):
        own = list(words)
        for k in range(8):
            own[20 + 30 * k] = f"s{k}x{rnd.randrange(30)}"
        docs.append((i, " ".join(own)))
    return docs


def all_pairs(docs, weigh="one", least=0.8):
    """Classes by the exact similarity of every pair (dense, for small tables)."""
    sets = [Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in (t.split() for _, t in docs)]
    if weigh == "one":
        sets = [Counter(dict.fromkeys(s, 1)) for s in sets]
    place = {x: k for k, x in enumerate({(x, j) for s in sets for x, n in s.items() for j in range(n)})}
    m = np.zeros((len(sets), len(place)), np.float32)
    for k, s in enumerate(sets):
        m[k, [place[x, j] for x, n in s.items() for j in range(n)]] = 1
    common, size = m @ m.T, m.sum(axis=1)
    u, v = np.nonzero(common >= least * (size[:, None] + size - common) - 1e-3)
    return grouped((docs[a][0], docs[b][0]) for a, b in zip(u.tolist(), v.tolist()))


def test_hidden_pairs_of_a_template(spark):
    docs = template_pages(300)
    want = all_pairs(docs)
    assert 150 < len(set(want.values())) < 290
    got = {r.doc_id: r.class_id for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id int, text string")).collect()}
    assert got == want


def test_exact_join_finds_all_pairs(spark, monkeypatch):
    """Without any link before it, of all sizes, weights of one and of counts, hot keys salted."""
    monkeypatch.setattr(N, "HOT", 7)
    rnd = random.Random(2)
    docs = [(i, " ".join(t.split()[: rnd.randint(1, 271)])) for i, t in template_pages(60)]
    docs += [(100 + i, " ".join([f"r{i % 9}"] * rnd.randint(1, 60) + ["a b c d e f"] * 4)) for i in range(60)]
    rows = [(i, i, t.encode()) for i, t in docs]
    apart = spark.createDataFrame(rows, "node long, component long, text binary")
    for weigh in ("one", "count"):
        pairs = {(r.u, r.v) for r in N._finish(apart, 5, weigh, 0.8).collect()}
        words = N.WordHashes()
        sets = {i: N._weighted(N.shingles(words, t, 5), weigh) for i, _, t in rows}
        want = {(a, b) for a in sets for b in sets if a < b and N.similarity(sets[a], sets[b]) >= 0.8 - 1e-9}
        assert want and want <= pairs and len(pairs) < len(docs) * (len(docs) - 1) / 2


def test_odd_rows(spark, odd_docs):
    got = sorted(((r.doc_id or -1), r.class_id) for r in N.near_duplicates(odd_docs).collect() if r.class_id is not None)
    assert got == [(-1, 1), (1, 1), (2, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7)]
    kept = N.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 7]
    assert N.near_duplicates(odd_docs.limit(0)).count() == 0

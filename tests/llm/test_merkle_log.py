from __future__ import annotations

import hashlib
import random

import pytest
from llm_fixtures import odd_docs  # noqa: F401

from pyspark.sql import functions as F

from spendlens.llm import merkle_log as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(tree, i):
    """Siblings of leaf i, level by level, and its place in each run."""
    out = []
    for nodes in tree[:-1]:
        run = nodes[i - i % 16 : i - i % 16 + 16]
        out.append((i % 16, run[: i % 16] + run[i % 16 + 1 :]))
        i //= 16
    return out


def brute(rows, change):
    """Plain trees over (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in by[s]]) for s in order]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            path = climb(trees[k], i) + climb(top, k)
            x = leaf(change(r))
            for at, others in path:
                x = sha("".join([*others[:at], x, *others[at:]]))
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[k][-1][0], root, sha("".join(h for _, o in path for h in o)), x, x == root))
    return sorted(out, key=str)


def lowered(r):
    if r[0] is None or r[0] % 5:
        return r
    text = r[4] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
    return (*r[:4], text)


def altered():
    """``lowered`` as columns."""
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(F.col("doc_id") % 5 == 0, small).otherwise(F.col("text"))}


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("seed,n,sources", [(1, 1, 1), (2, 700, 3), (3, 60, 40), (4, 4_500, 1)])
def test_trees_against_plain_ones(spark, seed, n, sources):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = rnd.choice([None, *(f"s{k}é" for k in range(sources))]) if sources > 1 else "one"
        text = rnd.choice([None, "", "plain", "Upper Ü", "x" * rnd.randint(0, 50)])
        rows.append((i if rnd.random() < 0.97 else rnd.choice([None, 3]), source, rnd.choice([None, "en"]), rnd.choice([None, 0, 17]), text))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    made = M.Manifest(df, altered=altered())
    got = sorted(map(tuple, made.verified().collect()), key=str)
    assert got == brute(rows, lowered)
    if n == 700:
        proofs = made.proofs().collect()
        assert sorted((str(r.id), r.leaf) for r in proofs) == sorted((str(r[0]), r[1]) for r in got)
        for r in proofs:
            assert M.fold(r.leaf, [s.asDict() for s in r.path]) == r.root == made.root()
    log = {}
    for r in made.log().collect():
        log.setdefault(r.tree, []).append(r)
    for nodes in log.values():  # postorder: every place is taken once, and a run's nodes come before their own
        nodes.sort(key=lambda r: r.position)
        assert [r.position for r in nodes] == list(range(len(nodes)))
        known = {(r.level, r["index"]): r for r in nodes}
        for r in nodes:
            assert r.position == M.position(r.level, r["index"], r.size)
            if r.level:
                run = [known[r.level - 1, i] for i in range(16 * r["index"], min(16 * r["index"] + 16, M.width(r.level - 1, r.size)))]
                assert run[-1].position == r.position - 1 and r.digest == M.digest_of([x.digest for x in run])


def test_equal_rows_and_odd_ones(spark, odd_docs):
    df = odd_docs.selectExpr("*", "CAST(NULL AS string) AS source", "'en' AS lang", "length(text) AS n_chars", "1 AS tree", "2 AS digest")
    rows = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted(map(tuple, M.Manifest(df, altered=altered()).verified().collect()), key=str)
    # equal rows are leaves of their own: their proofs differ in place only
    assert [r[:4] for r in got] == [r[:4] for r in brute(rows, lowered)] and all(r[6] for r in got)
    empty = M.Manifest(df.limit(0))
    assert empty.root() is None and empty.verified().count() == empty.log().count() == 0


def test_positions_of_ragged_trees():
    for size in (1, 2, 15, 16, 17, 255, 256, 257, 273, 4_097):
        order = []
        for first in range(0, size, 256):
            order += [(0, i) for i in range(first, min(first + 256, size))]
        nodes = [(lev, i) for lev in range(M.height(size) + 1) for i in range(M.width(lev, size))]
        places = sorted((M.position(lev, i, size), lev, i) for lev, i in nodes)
        assert [p for p, _, _ in places] == list(range(len(nodes)))
        assert places[-1][1:] == (M.height(size), 0)

from __future__ import annotations

import random
from llm_fixtures import odd_docs  # noqa: F401

from pyspark import Broadcast

from spendlens.llm.decontaminate import Shards, SuffixAutomaton, cut_words, decontaminate, find_contamination, normal_words


def brute(words, items, window=13):
    hit, found = set(), set()
    for k, item in enumerate(items):
        n = min(window, len(item))
        wins = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in wins:
                found.add(k)
                hit.update(range(i, i + n))
    return hit, found


def test_scan_is_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        window = rnd.choice([2, 3, 5])
        letters = [b"a", b"b", b"c"]
        items = sorted({tuple(rnd.choice(letters) for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 6))})
        doc = [rnd.choice([*letters, b"d"]) for _ in range(rnd.randint(0, 40))]
        spans, found = SuffixAutomaton([list(x) for x in items], window).scan(doc)
        want = brute(doc, items, window)
        assert {i for a, b in spans for i in range(a, b)} == want[0]
        assert found == want[1]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])), "spans are merged and in order"


def test_normal_words():
    assert normal_words("It's É-9 ABC\n".encode()) == [b"it", b"s", "É".encode(), b"9", b"abc"]
    assert normal_words(b"") == []


def test_cut_words():
    assert cut_words(b"a b, c d.", [(1, 3)]) == b"a ,  d."[:2] + b" d."


def test_odd_rows_and_shards(spark, odd_docs):
    items = [
        (1, " ".join(f"word{i}" for i in range(20, 40))),
        (2, None),
        (3, "ONE"),
        (4, ""),
        (5, " ".join(f"word{i}" for i in range(60, 73))),
        (None, "one"),
    ]
    bench = spark.createDataFrame(items, "item_id int, text string")
    for shard_words in (200_000, 20):
        got = {(r.doc_id, r.n_words): r for r in find_contamination(odd_docs, bench, shard_words=shard_words).collect()}
        assert got[1, 120].n_hit == 33 and got[1, 120]["items"] == ["1", "5"] and got[1, 120].contaminated
        assert got[6, 1].n_hit == 1 and got[6, 1]["items"] == ["3"]
        assert got[3, 0].n_hit == 0 and not got[3, 0].contaminated
        assert got[None, 120].n_hit == 33
    assert find_contamination(odd_docs.limit(0), bench).count() == 0
    none = find_contamination(odd_docs, bench.limit(0))
    assert none.where("n_hit > 0 or contaminated").count() == 0 and none.count() == odd_docs.count()


def test_many_shards_one_at_a_time(spark, monkeypatch):
    """A benchmark of many shards: the hits are those of brute force, and one automaton is loaded at a time."""
    rnd = random.Random(8)
    letters = "abcdefgh"
    items = [(i, " ".join(rnd.choice(letters) for _ in range(rnd.randint(1, 30)))) for i in range(40)] + [(90, None), (91, "")]
    docs = [(i, " ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))), "k") for i in range(50)]
    docs += [(60, items[3][1], "k"), (61, items[3][1], "k"), (61, items[3][1], "k"), (None, None, "k")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    df = spark.createDataFrame(docs, "doc_id int, text string, _key string")
    live, most = set(), [0]
    load = Shards.load

    def counted(self, k):
        live.add(k)
        most[0] = max(most[0], len(live))
        return load(self, k)

    destroy = Broadcast.destroy
    monkeypatch.setattr(Shards, "load", counted)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (live.clear(), destroy(self, *a))[1])
    rows = find_contamination(df, bench, window=4, shard_words=40).collect()
    assert len(Shards(bench, "item_id", "text", 4, 40).numbers) >= 8 and most[0] == 1
    words = [normal_words((t or "").encode()) for _, t in items]
    expected = []
    for i, t, _ in docs:
        own = normal_words((t or "").encode())
        hit, found = brute(own, words, 4)
        expected.append((str(i), len(own), len(hit), sorted(str(items[k][0]) for k in found)))
    got = [(str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in rows]
    assert sorted(got) == sorted(expected)
    one, many = (decontaminate(df, bench, window=4, min_cut=4, shard_words=n) for n in (200_000, 40))
    assert one.columns == many.columns == df.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_decontaminate_cuts_and_drops(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    filler = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame(
        [(1, passage, 9), (2, f"{filler}. {passage}, end", 9), (3, filler, len(filler))], "doc_id int, text string, n_chars int"
    )
    out = {r.doc_id: r for r in decontaminate(docs, spark.createDataFrame([(7, passage)], "item_id int, text string"), length_col="n_chars").collect()}
    assert set(out) == {2, 3}
    assert out[2].text == f"{filler}. , end" and out[2].n_chars == len(out[2].text)
    assert out[3].text == filler

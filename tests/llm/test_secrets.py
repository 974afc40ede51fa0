from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from llm_fixtures import documents, odd_docs  # noqa: F401

from spendlens.llm import secrets as S
from spendlens.llm.queries import QUERIES


@pytest.fixture(scope="module")
def field(documents):
    return S.fit(documents, max_windows=600)


def literal_spans(text):
    """The base spans by the contract's unbounded patterns, dropping failing matches afterwards."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [("assign", *m.span()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


def test_base_spans_are_the_literal_patterns():
    rnd = random.Random(7)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "abc", "123456", "AKIA", "AKIAB" * 5,
            "0123456789abcdef" * 2, "fade", "\n", "é", "==", "ſecret"]
    for _ in range(4000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert S.base_spans(text) == literal_spans(text), repr(text)
    assert S.base_spans("") == []


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 7))
        scores, move = rng.normal(0, 2, (n, 3)), rng.normal(0, 1.5, (3, 3))
        after, before = rng.random() < 0.5, rng.random() < 0.5

        def total(path):
            t = sum(scores[i][y] for i, y in enumerate(path)) + sum(move[a][b] for a, b in zip(path, path[1:]))
            return t + (move[0][path[0]] if after else 0) + (move[path[-1]][0] if before else 0)

        best = max(itertools.product(range(3), repeat=n), key=total)
        assert abs(total(S.viterbi(scores, move, after, before)) - total(best)) < 1e-9


def test_cutting_the_chain_changes_nothing():
    rng = np.random.default_rng(4)
    for _ in range(200):
        f = S.Field()
        f.move = rng.normal(0, 1, (3, 3))
        scorer = S.Scorer(f)
        scores = rng.normal(0, 1, (40, 3))
        scores[:, 0] += rng.choice([0, 8], 40)
        whole = [(i, y) for i, y in enumerate(S.viterbi(scores, f.move, False, False)) if y]
        assert scorer.tags(scores) == whole


def test_field_finds_what_it_learned_and_leaves_prose_alone(field, documents):
    scorer = S.Scorer(field)
    found = total = extra = 0
    for r in documents.collect():
        base = S.base_spans(r.text)
        alone = S.crf_spans(r.text, scorer, [])
        total += len(base)
        found += sum(any(a < z and x < b for _, a, b in alone) for _, x, z in base)
        extra += len(S.crf_spans(r.text, scorer, base))
    assert total >= 10 and found >= 0.9 * total
    assert extra <= 0.01 * documents.count()


def test_query_against_plain_scan(spark, documents):
    import hashlib

    got = {r.doc_id: r for r in QUERIES["op3_secret_scan"](spark, "/root/testdata/sf0.01").collect()}
    for d in documents.collect():
        base = literal_spans(d.text or "")
        r = got.pop(d.doc_id)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in S.KINDS[:3]]
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("crf")] == listed
    assert not got


def test_redaction_and_odd_rows(spark, odd_docs, field):
    assert S.redact_text("a bb cc d", [(2, 4), (3, 7), (8, 9)], "#") == "a # #"
    docs = spark.createDataFrame([(1, "x token = 'abcdef99' y AKIA" + "Z" * 16, 3), (2, None, 3)], "doc_id int, text string, n_chars int")
    out = {r.doc_id: r for r in S.redact(docs, field, length_col="n_chars").collect()}
    assert "abcdef99" not in out[1].text and "AKIA" not in out[1].text and out[1].n_chars == len(out[1].text)
    assert out[1].text.startswith("x ") and out[2].text == ""
    for f in (field, None):
        assert S.find_secrets(odd_docs, f).count() == odd_docs.count()
        assert S.redact(odd_docs, f).columns == odd_docs.columns
    assert S.fit(odd_docs) is None
    assert S.fit(odd_docs.limit(0)) is None and S.find_secrets(odd_docs.limit(0), None).count() == 0


def plain_spans(text, field, base):
    """Spans of the field by one Viterbi over the whole text and a comparison of all with all."""
    at = [m.span() for m in S.TOKEN.finditer(text)]
    if not at:
        return []
    tokens, file = [text[a:b] for a, b in at], S.file_features(text)
    e = np.zeros((len(tokens), 3)) + field.file[[S._bucket(f) for f in file]].sum(axis=0)
    for j, t in enumerate(tokens):
        e[j] += field.own[[S._bucket(f) for f in S.shape_features(S.shape(t))]].sum(axis=0)
        for p, d in enumerate((-1, -2, 1)):
            if 0 <= j + d < len(tokens):
                e[j] += field.near[p][S._bucket(S.context_feature(tokens[j + d]))]
    spans, last = [], None
    for j, y in enumerate(S.viterbi(e, field.move, False, False)):
        if y:
            if y == S.INSIDE and last == j - 1:
                spans[-1][1] = at[j][1]
            else:
                spans.append(list(at[j]))
            last = j
    return [("crf", a, b) for a, b in spans if not any(a < z and x < b for _, x, z in base)]


def test_spans_of_the_query_are_a_plain_decode_of_every_text(spark, documents):
    field = S.fit(documents)
    got = {r.doc_id: r.spans for r in QUERIES["op3_secret_scan"](spark, "/root/testdata/sf0.01").collect()}
    some = 0
    for d in documents.collect():
        base = literal_spans(d.text or "")
        crf = plain_spans(d.text or "", field, base)
        listed = sorted([*base, *crf], key=lambda s: (s[1], S.KINDS.index(s[0])))
        assert got[d.doc_id] == ",".join(f"{k}:{a}:{b}" for k, a, b in listed), d.doc_id
        some += len(crf)
    texts = [f"see {'x1Y2' * 5} and password: {'q9' * 6}, it" for _ in range(3)] + ["", "a", "key " * 50 + "Zx81kQpL0aBcD9" * 3]
    scorer = S.Scorer(field)
    for t in texts:
        base = S.base_spans(t)
        assert S.crf_spans(t, scorer, base) == plain_spans(t, field, base)


def test_gradient_is_the_numeric_one():
    rng = np.random.default_rng(5)
    windows = []
    for n in (1, 2, 5, 9):
        tokens = [rng.choice(["password", "=", "a1B2c3d4e5f6", "the", "key", "'", "0123456789abcdef0123"]) for _ in range(n)]
        windows.append({"tokens": tokens, "tags": rng.integers(0, 3, n).tolist(), "file": ["assign=1", f"digits={n}"]})
    sample, weights = S.Sample(windows), S.zero_weights()
    for w in weights:
        w[...] = rng.normal(0, 0.5, w.shape)
    weights[0][S._PAD] = weights[2][S._PAD] = 0
    weights[1][:, S._PAD] = 0
    grads = S.likelihood(weights, sample)[1]
    step, checked = 1e-5, 0
    for w, g in zip(weights, grads):
        places = [tuple(p) for p in np.argwhere(np.abs(g) > 1e-6) if S._PAD not in p[:-1]]
        for k in rng.choice(len(places), min(25, len(places)), replace=False):
            at, before = places[k], w[places[k]]
            w[at] = before + step
            up = S.likelihood(weights, sample)[0]
            w[at] = before - step
            down = S.likelihood(weights, sample)[0]
            w[at] = before
            assert abs((up - down) / (2 * step) - g[at]) < 1e-4
            checked += 1
    assert checked > 50


def test_intervals_against_all_of_them():
    rnd = random.Random(6)
    for _ in range(300):
        spans = []
        for kind in S.KINDS[:3]:
            at = 0
            while (at := at + rnd.randint(0, 9)) < 60:
                spans.append((kind, at, at := at + rnd.randint(1, 6)))
        spans.sort(key=lambda s: (s[1], S.KINDS.index(s[0])))
        known = S.Intervals(spans)
        for a in range(0, 66, 3):
            for b in (a + 1, a + 4):
                assert known.first(a, b) == next((i for i, (_, x, z) in enumerate(spans) if a < z and x < b), None)


def test_many_secrets_in_one_text(field):
    """Twenty thousand secrets in a text, with and without white space: time grows with the text, not its square."""
    import time

    scorer = S.Scorer(field)
    for between in ("\n", ";"):
        text = between.join(f"password={i:09d}abc" for i in range(20_000))
        start = time.time()
        base = S.base_spans(text)
        S.crf_spans(text, scorer, base)
        assert len(base) == 20_000 and time.time() - start < 6
        start = time.time()
        assert len(S.training_windows(text)) == 20_001 and time.time() - start < 20
    token = "aB3" * 200_000
    assert S.shape(token)[1:4] == (12, 8, 1)


def test_copies_do_not_flood_the_sample(spark, monkeypatch):
    """A third of the table is one text; the sample keeps its bound and holds that text's windows once."""
    copy = "\n".join(f"line {i} has api_key = K{i:03d}abcdefgh" for i in range(40))
    rows = [(i, copy) for i in range(400)] + [(1_000 + i, f"text {i} with secret: {i:05d}xyz{i} in it, and more of it {i * i}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    seen = []
    monkeypatch.setattr(S, "train", lambda windows: seen.append(windows))
    S.fit(df, max_windows=300)
    S.fit(df, max_windows=10_000)
    few, all_ = seen
    assert 150 < len(few) <= 300 and len({(w["draw"], w["secret"]) for w in few}) == len(few)
    assert len({tuple(w["tokens"]) for w in all_ if w["secret"]}) == sum(w["secret"] for w in all_) == 840

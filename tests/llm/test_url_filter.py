from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from spendlens.llm import url_filter as U
from spendlens.llm.queries import QUERIES, URL_RULES

RULES = URL_RULES


def plain(url, rules=RULES):
    """Host, path, rule and verdict by the definition."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:at]), rest[at:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for r in rules:
        h, _, p = r.rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.rule) > len(best.rule)):
            best = r
    return host, path, best.rule if best else None, best.verdict if best else None


def pagerank(edges, seeds, damping=U.DAMPING, steps=400):
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    index = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        m[index[b], index[a]] += n
    out = m.sum(axis=0)
    m = m / np.where(out, out, 1)
    s = np.array([float(seeds.get(h, 0)) for h in hosts])
    r = s.copy()
    for _ in range(steps):
        f = damping * m @ r
        r = f + (s / s.sum() * (s.sum() - f.sum()) if s.sum() else 0)
    return dict(zip(hosts, r))


def test_rules_over_odd_urls(spark):
    urls = [
        "http://a.com/x?q#f", "HTTP://A.Example.COM/en/1", "https://www.example.com/en/", "http://example.com/en", "http://example.com",
        "http://b.net/es/a?b://c", "http://net/fr/#x", "http://xnet/fr/", "no scheme", "", None, "a://", "://h/p", "http://É.COM/",
        "http://h.com?x/y", "http://h.com#/en/", "first://second://third/x", "http://u@h.com:80/x\ny",
    ]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id int, url string, html string")
    got = {r.page_id: r for r in U.filter_urls(df, RULES).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        if verdict:
            assert got[i].verdict == verdict


def test_query_rules(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in QUERIES["op2_url_filter"](spark, sf).collect()}
    for p in spark.read.parquet(f"{sf}/pages.parquet").collect():
        host, path, rule, verdict = plain(p.url)
        r = got.pop(p.page_id)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) in ("allow", "block")
    assert not got


def test_walks_are_personalised_pagerank(spark):
    rnd = random.Random(2)
    names = [f"h{i}" for i in range(12)]
    edges = sorted({(a, b): rnd.randint(1, 5) for a, b in (rnd.sample(names, 2) for _ in range(25))}.items())
    edges = [(a, b, n) for (a, b), n in edges]
    hosts = [(h, rnd.randint(0, 3), rnd.choice([0, 0, 2])) for h in names]
    got = U.propagate(
        spark.createDataFrame(edges, "src string, dst string, pages long"),
        spark.createDataFrame(hosts, "host string, trusted long, blocked long"),
        tolerance=1e-4,
    )
    trust = pagerank(edges, {h: t for h, t, _ in hosts})
    distrust = pagerank([(b, a, n) for a, b, n in edges], {h: b for h, _, b in hosts})
    for r in got.collect():
        assert abs(r.trust - trust[r.host]) < 1e-3 and abs(r.distrust - distrust[r.host]) < 1e-3


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    link = '<a href="{}">x</a>'
    rows = [
        *[(i, f"http://bad.org/x{i}", None) for i in range(20)],
        *[(100 + i, "http://farm.org/", link.format("http://BAD.org/x1")) for i in range(3)],
        *[(200 + i, "http://good.org/", link.format("//fine.org:8080/y") + link.format("/own")) for i in range(3)],
        (300, "http://fine.org/", "<p>http://bad.org/ is only text here</p>"),
        (400, None, link.format("http://bad.org/")),
        (401, None, None),
    ]
    rules = (U.Rule("block", "bad.org/"), U.Rule("allow", "good.org/"))
    df = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("host", F.lit(1))
    got = {r.page_id: r.verdict for r in U.filter_urls(df, rules).collect()}
    assert {got[i] for i in range(20)} == {"block"}
    assert got[100] == got[101] == got[102] == "block"
    assert got[200] == "allow" and got[300] == "allow" and got[400] == got[401] == "allow"


def test_walks_go_on_until_far_hosts_are_right(spark):
    """A ring of 50 hosts, one of them blocked with so many pages that hosts far behind it are near the threshold."""
    n = 50
    edges = [(f"h{i}", f"h{(i + 1) % n}", 1) for i in range(n)]
    blocked = 5_000
    scores = {
        r.host: r
        for r in U.propagate(
            spark.createDataFrame(edges, "src string, dst string, pages long"),
            spark.createDataFrame([("h0", 0, blocked)], "host string, trusted long, blocked long"),
        ).collect()
    }
    exact = pagerank([(b, a, k) for a, b, k in edges], {"h0": blocked})
    assert max(abs(scores[h].distrust - exact[h]) for h in exact) < U.GRAIN
    far = [exact[f"h{i}"] for i in range(1, n)]
    assert min(far) < 0.5 < max(far)  # the threshold of a page lies within the ring
    grain = lambda x: round(x / U.GRAIN)
    assert [grain(scores[h].distrust) >= grain(U.THRESHOLD) for h in exact] == [grain(exact[h]) >= grain(U.THRESHOLD) for h in exact]


def test_a_page_counts_once_for_a_host(spark):
    rows = [
        ("a.com", '<a Href=//B.com><img SRC="//b.com/"><a href="http://u@b.com:80/x">' + "<p>" * 400_000),
        ("a.com", '<a href="//b.com">'),
        ("a.com", '<a href="//b.com">'),  # a repeated page is a page
        ("a.com", "<a nohref='#'> hrefs=//c.com //c.com"),
        ("a.com", None),
        ("b.com", '<A HREF = //A.COM:443/>'),
    ]
    df = spark.createDataFrame(rows, "_host string, _html string")
    assert sorted(map(tuple, U.host_edges(df, "_html").collect())) == [("a.com", "b.com", 3), ("b.com", "a.com", 1)]


def test_columns_of_any_name(spark):
    rows = [(1, "http://a.com/", "x", 0, "y"), (1, "http://a.com/", "x", 0, "y")]
    df = spark.createDataFrame(rows, "`p.id` int, `the.url` string, `h.tml` string, host int, _rule string")
    got = U.filter_urls(df, RULES, id_col="p.id", url_col="the.url", html_col="h.tml").collect()
    assert [(r["p.id"], r.host, r.verdict) for r in got] == [(1, "a.com", "allow")] * 2


def test_equal_trust_and_distrust_allow(spark):
    link = '<a href="http://{}/">'
    rows = [(i, "http://good.org/", link.format("m.org")) for i in range(3)] + [(10 + i, "http://bad.org/", None) for i in range(3)]
    rows += [(20, "http://m.org/", link.format("bad.org")), (21, "http://m.org/", None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    rules = (U.Rule("allow", "good.org/"), U.Rule("block", "bad.org/"))
    assert {r.verdict for r in U.filter_urls(df, rules).collect() if r.host == "m.org"} == {"allow"}


def test_empty(spark):
    df = spark.createDataFrame([], "page_id int, url string, html string")
    assert U.filter_urls(df, RULES).count() == 0


def test_sql_of_the_query_with_links(spark, tmp_path):
    """The query and its SQL over pages whose hosts do link."""
    from compare import digest, duck_rows, spark_rows
    from spendlens.llm.oracle import ORACLE_SQL

    import duckdb

    rnd = random.Random(4)
    hosts = [f"{a}.example.{b}" for a in ("x", "y", "www", "z", "q") for b in ("com", "net", "org")]
    pages = []
    for i in range(300):
        links = "".join(f'<a href="{rnd.choice(["http://", "//", "HTTPS://u@"])}{rnd.choice(hosts).upper()}:80/p">l</a>' for _ in range(rnd.randint(0, 4)))
        host = rnd.choice(hosts)
        folder = rnd.choice(["es", "fr", "es", "en"] if host.endswith("net") else ["en", "fr", "es", "de"])
        pages.append((i, f"http://{host}/{folder}/{i}", links or None))
    pages += [(500 + i, f"http://evil.net/{'fr' if i else 'en'}/", None) for i in range(30)]
    pages += [(600, "http://farm.org/", '<a href="http://evil.net/">')]
    pages += [(1000, None, None), (1001, "none", '<a href="//x.example.org/">')]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = spark_rows(QUERIES["op2_url_filter"](spark, str(tmp_path)))
    assert digest(*got) == digest(*duck_rows(con, ORACLE_SQL["op2_url_filter"]))
    assert {r[got[0].index("verdict")] for r in got[1] if r[got[0].index("rule")] is None} == {"allow", "block"}

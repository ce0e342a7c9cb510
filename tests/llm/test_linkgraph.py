import numpy as np
import pytest
from conftest import rows

from rawline.llm.linkgraph import DAMPING, ROUNDS, host_edges, judge_urls, propagate
from rawline.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, rule string"


@pytest.mark.parametrize(
    "url,host,path,rule",
    [
        (None, "", "", None),
        ("", "", "", None),
        ("example.com/en/", "", "", None),
        ("http://A.ÄExample.COM/en/x?y#z", "a.Äexample.com", "/en/x", "com/"),
        ("x://example.com/en/", "example.com", "/en/", "example.com/en/"),
        ("x://example.com/en", "example.com", "/en", "com/"),
        ("x://example.com", "example.com", "", None),
        ("x://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
        ("x://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/"),
        ("x://badexample.com/en/", "badexample.com", "/en/", "com/"),
        ("x://com/", "com", "/", "com/"),
        ("x://a.net/es/1", "a.net", "/es/1", "net/es/"),
        ("x://a.net/de/1", "a.net", "/de/1", None),
        ("x://a.net?p=/es/", "a.net", "", None),
        ("x://y://a.net/fr/", "y:", "//a.net/fr/", None),
        ("\nhttp://a.net\n/fr/", "a.net\n", "/fr/", None),
    ],
)
def test_hosts_and_rules(spark, url, host, path, rule):
    df = spark.createDataFrame([(1, url, None, "clash")], PAGES)
    assert rows(judge_urls(df, URL_RULES), "host", "path", "rule") == [(host, path, rule)]


def test_edges(spark):
    html = '<a href="http://B.org/x">b</a> <A HREF=//c.org> <img src=\'https://b.org\'> <a href="/local"> <a href="http://a.org/"> href'
    df = spark.createDataFrame([("a.org", html), ("a.org", html), ("", html), ("b.org", None)], "host string, html string")
    assert rows(host_edges(df)) == [("a.org", "b.org", 4), ("a.org", "c.org", 2)]


def plain_scores(seeds, edges):
    hosts = sorted({h for h, *_ in seeds} | {x for a, b, _ in edges for x in (a, b)})
    at = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        w[at[a], at[b]] = n
    t0, b0 = np.zeros(len(hosts)), np.zeros(len(hosts))
    for h, t, b in seeds:
        t0[at[h]], b0[at[h]] = t, b

    def flow(x, m, start):
        out = m.sum(axis=1, keepdims=True)
        share = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
        return (1 - DAMPING) * start + DAMPING * (x @ share + np.where(out[:, 0] > 0, 0, x))

    t, b = t0, b0
    for _ in range(ROUNDS):
        t, b = flow(t, w, t0), flow(b, w.T, b0)
    return {h: (t[i], b[i]) for h, i in at.items()}


def test_propagation_equals_matrices(spark):
    rng = np.random.default_rng(0)
    edges = [(f"h{a}", f"h{b}", int(rng.integers(1, 9))) for a in range(12) for b in rng.choice(15, 3, replace=False) if a != b]
    seeds = [("h0", 0.5, 0.0), ("h3", 0.25, 0.1), ("h7", 0.0, 0.4), ("lone", 0.0, 0.3)]
    got = propagate(spark.createDataFrame(seeds, "host string, trust0 double, distrust0 double"), spark.createDataFrame(edges, "a string, b string, n long"))
    want = plain_scores(seeds, edges)
    found = {r["host"]: (r["trust"], r["distrust"]) for r in got.collect()}
    assert found.keys() == want.keys()
    assert all(np.allclose(found[h], want[h], atol=1e-9) for h in want)


def test_popular_host_and_no_windows(spark, capsys):
    """Half of all links point to one host, as many leave another; sums of a
    host's links come from partial sums, not from a window over its links."""
    edges = [(f"h{i}", "hub", 1 + i % 3) for i in range(40)] + [("out", f"h{i}", 1 + i % 2) for i in range(40)]
    seeds = [("hub", 0.0, 0.5), ("out", 0.5, 0.0)]
    frame = spark.createDataFrame(edges, "a string, b string, n long")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in propagate(spark.createDataFrame(seeds, "host string, trust0 double, distrust0 double"), frame).collect()}
    want = solved_scores(seeds, edges)
    assert got.keys() == want.keys() and all(np.allclose(got[h], want[h], rtol=1e-9, atol=1e-12) for h in want)
    df = spark.createDataFrame([(1, "http://bad.net/es/1", None, "r"), (2, "http://farm.org/x", '<a href="http://bad.net/">', "r")], PAGES)
    judge_urls(df, URL_RULES).explain("simple")
    assert "Window" not in capsys.readouterr().out


def solved_scores(seeds, edges):
    hosts = sorted({h for h, *_ in seeds} | {x for a, b, _ in edges for x in (a, b)})
    at = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        w[at[a], at[b]] = n

    def solve(m, start):
        out = m.sum(axis=1)
        flow = np.where(out[:, None] > 0, m / np.maximum(out, 1)[:, None], np.eye(len(m)))
        return np.linalg.solve(np.eye(len(m)) - DAMPING * flow.T, (1 - DAMPING) * start)

    start = np.zeros((2, len(hosts)))
    for h, *s in seeds:
        start[:, at[h]] = s
    t, b = solve(w, start[0]), solve(w.T, start[1])
    return {h: (t[i], b[i]) for h, i in at.items()}


def test_long_chain_equals_the_solved_system(spark):
    edges = [(f"c{i}", f"c{i + 1}", 1) for i in range(24)]  # c24 is a blocked seed
    seeds = [("c24", 0.0, 0.4), ("c3", 0.3, 0.0)]
    got = propagate(spark.createDataFrame(seeds, "host string, trust0 double, distrust0 double"), spark.createDataFrame(edges, "a string, b string, n long"))
    found = {r["host"]: (r["trust"], r["distrust"]) for r in got.collect()}
    want = solved_scores(seeds, edges)
    assert found.keys() == want.keys()
    assert all(np.allclose(found[h], want[h], rtol=1e-9, atol=1e-12) for h in want)
    assert found["c0"][1] > 1e-12


def test_distrust_flows_back_along_links(spark):
    link = '<a href="http://{}/">'.format
    data = [
        (1, "http://bad.net/es/1", None),
        (2, "http://farm.org/x", link("bad.net")),
        (3, "http://fine.org/x", link("ok.com")),
        (4, "http://ok.com/x", link("named.org")),
        (5, "http://named.org/x", None),
        (6, "http://bad.net/de/", None),
        (6, "http://bad.net/de/", None),
        (7, None, link("bad.net")),
    ]
    df = spark.createDataFrame([(*d, "r") for d in data], PAGES)
    got = rows(judge_urls(df, URL_RULES), "page_id", "verdict")
    assert got == [(1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "allow"), (6, "block"), (6, "block"), (7, "allow")]
    assert judge_urls(df.limit(0), URL_RULES).count() == 0

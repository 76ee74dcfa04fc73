import numpy as np
from pyspark.sql import types as T

from tidemark.llm import url_filter as uf

from rows import SMALL

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                      T.StructField("trust", T.StringType())])


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host_end = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    path = rest[host_end:]
    end = min([k for k in map(path.find, "?#") if k >= 0], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:host_end]), path[:end]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_rules_on_the_small_table(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = uf.op3_url_filter(spark, SMALL).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == split(urls[r.page_id])
        name, verdict = rule(r.host, r.path)
        assert r.rule == name and r.verdict in ("allow", "block") and verdict in (None, r.verdict)


def test_awkward_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://ExAmple.COM/EN/x", "a://b.example.com/en/?q#f", "x://net",
            "x://net/es/", "x://net/es", "x://www.example.com/en/1", "x://notexample.com/en/", "x://É.net/fr/#/",
            "http://a.net?u=http://b.com/", "x://net/es/"]
    pages = spark.createDataFrame([(k, u, None, "x", "x") for k, u in enumerate(urls)], PAGES)
    got = {r.page_id: r for r in uf.filter_urls(pages).collect()}
    for k, u in enumerate(urls):
        assert (got[k].host, got[k].path) == split(u), u
        assert got[k].rule == rule(*split(u))[0], u
    assert uf.filter_urls(pages.limit(0)).count() == 0


def test_link_graph_decides_the_rest(spark):
    def link(*hosts):
        return "".join(f'<a href="http://{h}/x">' for h in hosts)
    pages = spark.createDataFrame([
        (1, "http://good.com/a", link("fine.org"), "", ""), (2, "http://bad.net/es/", "", "", ""),
        (3, "http://farm.org/", link("bad.net", "bad.net"), "", ""), (4, "http://fine.org/", "", "", ""),
        (5, "http://alone.org/", "", "", "")], PAGES)
    got = {r.page_id: (r.rule, r.verdict) for r in uf.filter_urls(pages).collect()}
    assert got == {1: ("com/", "allow"), 2: ("net/es/", "block"), 3: (None, "block"),
                   4: (None, "allow"), 5: (None, "allow")}


def test_propagation_equals_dense_power_iteration(spark):
    rng = np.random.default_rng(2)
    n = 12
    w = rng.integers(0, 3, (n, n))
    np.fill_diagonal(w, 0)
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(w[i, j])) for i in range(n) for j in range(n) if w[i, j]],
                                  "src string, dst string, links long")
    t0, d0 = np.zeros(n), np.zeros(n)
    t0[:3], d0[-2:] = 1 / 3, 1 / 2
    seeds = spark.createDataFrame([(f"h{i}", float(t0[i]), float(d0[i])) for i in range(n)],
                                  "host string, trust double, distrust double")
    got = {r.host: r for r in uf.propagate(edges, seeds).collect()}
    out = w / np.maximum(1, w.sum(1, keepdims=True))
    into = w / np.maximum(1, w.sum(0, keepdims=True))
    t, d = (1 - uf.DAMPING) * t0, (1 - uf.DAMPING) * d0
    for _ in range(uf.ROUNDS):
        t = (1 - uf.DAMPING) * t0 + uf.DAMPING * out.T @ t
        d = (1 - uf.DAMPING) * d0 + uf.DAMPING * into @ d
    for i in range(n):
        assert np.isclose(got[f"h{i}"].trust, t[i]) and np.isclose(got[f"h{i}"].distrust, d[i])


def test_ranks_have_converged(spark):
    """A ring, whose rank mass goes round, against the solved equations; a host far from all seeds."""
    n = 8
    w = np.roll(np.eye(n), 1, axis=1) + np.roll(np.eye(n), 3, axis=1)
    t0, d0 = np.eye(n)[0], np.eye(n)[5]
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(w[i, j])) for i in range(n) for j in range(n) if w[i, j]],
                                  "src string, dst string, links long")
    seeds = spark.createDataFrame([(f"h{i}", float(t0[i]), float(d0[i])) for i in range(n)],
                                  "host string, trust double, distrust double")
    got = {r.host: r for r in uf.propagate(edges, seeds).collect()}
    p = w / w.sum(1, keepdims=True)
    q = w / w.sum(0, keepdims=True)
    t = np.linalg.solve(np.eye(n) - uf.DAMPING * p.T, (1 - uf.DAMPING) * t0)
    d = np.linalg.solve(np.eye(n) - uf.DAMPING * q, (1 - uf.DAMPING) * d0)
    for i in range(n):
        assert np.isclose(got[f"h{i}"].trust, t[i], 1e-3) and np.isclose(got[f"h{i}"].distrust, d[i], 1e-3)


def test_a_chain_of_eight_links_to_a_blocked_seed(spark):
    hosts = [f"c{k}.org" for k in range(8)] + ["bad.net"]
    pages = spark.createDataFrame(
        [(k, f"http://{h}/es/", f'<a href="http://{nxt}/es/">' if nxt else "", "", "")
         for k, (h, nxt) in enumerate(zip(hosts, [*hosts[1:], None]))], PAGES)
    got = {r.page_id: (r.verdict, r.distrust) for r in uf.filter_urls(pages).collect()}
    assert all(got[k][0] == "block" for k in range(9))
    assert all(np.isclose(got[k][1], 0.15 * 0.85 ** (8 - k)) for k in range(9))

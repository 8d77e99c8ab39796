"""Link propagation over more than one link."""

import random

import numpy as np
import pytest

from tidegrid.llm import urls


def test_a_blocked_host_with_many_linkers(spark):
    bad, good = '<a href="http://bad.org/x">x</a>', '<a href="http://fine.net/x">x</a>'
    rows = [(k, f"http://bad.org/es/{k}", None) for k in range(3)] + [(k, f"http://fine.net/de/{k}", None) for k in range(3, 6)]
    rows += [(10 + k, f"http://u{k}.info/a", bad) for k in range(5)] + [(20, "http://v.info/a", good), (21, "http://w.info/a", '<a href="http://u1.info/">u</a>')]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[10 + k] for k in range(5)] == ["block"] * 5
    assert got[3] == "allow" and got[20] == "allow"


def graph(n, edges, seed):
    """Scores of all rounds, in plain numpy; hosts without links out keep what they have."""
    p, out = np.zeros((n, n)), np.zeros(n)
    for a, b, w in edges:
        p[a, b] += w
        out[a] += w
    for a in range(n):
        if out[a]:
            p[a] /= out[a]
        else:
            p[a, a] = 1
    x = seed.copy()
    for _ in range(400):
        x = 0.15 * seed + 0.85 * x @ p
    return x, p * (out > 0)[:, None]


def test_propagation_matches_brute_force(spark):
    """Cycles, hosts without links out, hosts without links in, weights, many rounds."""
    r = random.Random(4)
    n = 30
    edges = [(k, (k + 1) % 12, 1.0) for k in range(12)]  # a ring: mass needs many rounds to settle
    edges += sorted({(r.randrange(24), r.randrange(4, 28), float(r.randint(1, 3))) for _ in range(40)})
    edges = list({(a, b): (a, b, w) for a, b, w in edges if a != b}.values())
    seeds = [(k, r.random() if k % 3 == 0 else 0.0, r.random() if k % 4 == 1 else 0.0) for k in range(n - 2)]
    name = lambda k: f"h{k}"
    df = spark.createDataFrame([(name(a), name(b), w) for a, b, w in edges], "src string, dst string, w double")
    given = spark.createDataFrame([(name(k), t, d) for k, t, d in seeds], "host string, trust double, distrust double")
    got = {x.host: (x.trust, x.distrust) for x in urls.shares(given, df, tolerance=1e-9).collect()}
    for column, links in ((0, edges), (1, [(b, a, w) for a, b, w in edges])):
        own = np.zeros(n)
        for k, *s in seeds:
            own[k] = s[column]
        x, p = graph(n, links, own)
        most, _ = graph(n, links, np.ones(n))
        come, full = x @ p, most @ p
        for k in range(n):
            if name(k) in got:
                want = 0.85 * min(1.0, come[k] / full[k]) if full[k] else 0.0
                assert got[name(k)][column] == pytest.approx(want, abs=1e-6), (k, column)
    assert len(got) == n - 2
    rough = {x.host: (x.trust, x.distrust) for x in urls.shares(given, df).collect()}
    assert all(np.allclose(rough[h], got[h], atol=5e-3) for h in got)


def test_odd_pages(spark):
    long = "<a href='http://far.org/x'>" * 20_000
    rows = [(1, "http://a.info/x", long, "c"), (1, "http://a.info/x", long, "c"), (None, None, None, None), (2, "://", "", ""), (3, "http://far.org/es/1", None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = [(r.page_id, r.host, r.verdict) for r in urls.judge(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, "a.info", "block")] * 2 + [(None, "", "allow"), (2, "", "allow"), (3, "far.org", "block")]))

import pytest

from plumbline.llm import url_filter as u

CASES = [
    # url, host, path, rule, verdict
    ("http://a.b.net/x", "a.b.net", "/x", "net/", "block"),
    ("https://EXAMPLE.net/en/1?q=/de/#x", "example.net", "/en/1", "example.net/en/", "allow"),
    ("https://m.example.net/EN/1", "m.example.net", "/EN/1", "net/", "block"),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("https://x.example.com/de/", "x.example.com", "/de/", "example.com/de/", "block"),
    ("https://x.example.com/de", "x.example.com", "/de", None, "allow"),
    ("https://y.org/fr/", "y.org", "/fr/", "org/fr/", "allow"),
    ("http://z.net", "z.net", "", None, "allow"),
    ("http://z.net?/a/", "z.net", "", None, "allow"),
    ("x://y://z/p", "y:", "//z/p", None, "allow"),
    ("no scheme/at all", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://", "", "", None, "allow"),
    ("http://ÄB.Org/fr/é", "Äb.org", "/fr/é", "org/fr/", "allow"),
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, c[0], None, "clash") for i, c in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in u.filter_pages(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), CASES[i]


def page(i, host, *links):
    return (i, f"https://{host}/p", "".join(f'<p><A class=x href="{link}">t</A>' for link in links))


@pytest.fixture(scope="module")
def linked(spark):
    rows = [
        page(0, "bad.net"),
        page(1, "farm.com", "http://bad.net/1", "//BAD.net/2", "https://farm.com/own"),
        page(2, "mixed.com", "https://bad.net/", "https://good.com/", "https://good.com/2", "https://a.com", "https://b.com"),
        page(3, "good.com", "/relative", "https://a.com/"),
        page(4, "a.com"),
        page(5, "far.com", "https://farm.com/"),
        (6, "https://good.org/fr/1", '<a href="https://good.com/">'),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_edges_are_links_between_hosts(linked):
    edges = {(r.src, r.dst): r.links for r in u.host_edges(linked).collect()}
    assert edges[("farm.com", "bad.net")] == 2 and edges[("mixed.com", "good.com")] == 2
    assert ("farm.com", "farm.com") not in edges and len(edges) == 8


def brute(edges, seeds, rounds):
    mass = dict(seeds)
    for _ in range(rounds):
        new = {h: int((1 - u.DAMPING) * s // 1) for h, s in seeds.items()}
        for (a, b), n in edges.items():
            total = sum(m for (x, _), m in edges.items() if x == a)
            new[b] = new.get(b, 0) + int(u.DAMPING * mass.get(a, 0) * n / total // 1)
        mass = new
    return mass


def test_distrust_runs_backward_and_trust_forward(linked):
    rows = {r.page_id: r for r in u.filter_pages(linked).collect()}
    edges = {(r.src, r.dst): r.links for r in u.host_edges(linked).collect()}
    trust = brute(edges, {"good.org": u.UNITS}, u.ROUNDS)
    distrust = brute({(b, a): n for (a, b), n in edges.items()}, {"bad.net": u.UNITS}, u.ROUNDS)
    for r in rows.values():
        assert r.trust == trust.get(r.host, 0) / u.UNITS
        assert r.distrust == distrust.get(r.host, 0) / u.UNITS
    assert rows[1].verdict == "block" and rows[1].rule is None
    assert rows[5].verdict == "block"
    assert rows[3].verdict == rows[4].verdict == "allow"


def test_no_pages_and_repeated_rows(linked):
    assert u.filter_pages(linked.limit(0)).count() == 0
    assert u.filter_pages(linked.union(linked)).count() == 14

from __future__ import annotations

from pyspark.sql import functions as F

from lapseflow.llm import url_reputation as d

URLS = [
    ("https://www.Example.COM/en/1?x=/en/", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("http://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://example.com?a=/en/", "example.com", "", None, "allow"),
    ("x://a.net/fr/b#c/es/", "a.net", "/fr/b", "net/fr/", "block"),
    ("x://net/es/", "net", "/es/", "net/es/", "block"),
    ("x://anet/es/", "anet", "/es/", None, "allow"),
    ("a://b.com/c://d.net/es/", "b.com", "/c://d.net/es/", "com/", "allow"),
    ("no scheme.com/en/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("s://H\nX.com/a\nb?c", "h\nx.com", "/a\nb", "com/", "allow"),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)] + [(None, URLS[1][0]), (1, URLS[1][0])], "page_id bigint, url string")
    none = spark.createDataFrame([], "page_id bigint, good int")
    got = d.judged(pages.selectExpr("*", "page_id AS host", "url AS mean"), none).collect()
    assert len(got) == len(URLS) + 2
    want = {i: u[1:] for i, u in enumerate(URLS)} | {None: URLS[1][1:]}
    assert all((r["host"], r["path"], r["rule"], r["verdict"]) == want[r["page_id"]] for r in got)
    assert d.judged(pages.limit(0), none).count() == 0
    assert {r["rule"] for r in d.judged(pages, none, rules=()).collect()} == {None}


def brute(counts):
    """Posterior means of hosts from {host: (n, good)}, level by level."""

    def level(groups, parent):
        spread = n = k = 0
        for key, (m, g) in groups.items():
            p = parent(key)
            if m:
                spread, n, k = spread + (g - m * p) ** 2 / (m * p * (1 - p)), n + m, k + 1
        r = d.LEAST if not k or n <= k else min(d.MOST, max(d.LEAST, (spread - k) / (n - k)))
        s = (1 - r) / r
        return {key: ((g + s * parent(key)) / (m + s), m + s) for key, (m, g) in groups.items()}

    def by(key):
        out = {}
        for h, (n, g) in counts.items():
            a, b = out.get(key(h), (0, 0))
            out[key(h)] = (a + n, b + g)
        return out

    end = lambda h: ".".join(h.split(".")[-2:]) if ".".join(h.split(".")[-2:]) in d.LONG_SUFFIXES else h.split(".")[-1]
    domain = lambda h: ".".join(h.split(".")[-(end(h).count(".") + 2) :])
    n, g = sum(x[0] for x in counts.values()), sum(x[1] for x in counts.values())
    suffixes = level(by(end), lambda _: (g + 1) / (n + 2))
    domains = level(by(domain), lambda x: suffixes[end(x)][0])
    return level(counts, lambda x: domains[domain(x)][0])


def test_posteriors_equal_brute_force(spark):
    hosts = {"a.x.co.uk": (40, 2), "b.x.co.uk": (3, 0), "c.x.co.uk": (0, 0), "y.co.uk": (9, 9), "good.com": (50, 48), "w.good.com": (1, 0), "bad.org": (60, 3), "new.org": (0, 0), "": (2, 1)}
    pages, known = [], []
    for host, (n, good) in hosts.items():
        for k in range(n + 1):
            pages.append((len(pages), f"http://{host}/p" if host else None))
            if k < n:
                known.append((len(pages) - 1, int(k < good)))
    got = d.judged(
        spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(known, "page_id bigint, good int"), rules=()
    ).select("host", "mean", "bound", "verdict").distinct().collect()
    want = brute(hosts)
    assert len(got) == len(hosts)
    for r in got:
        mean, seen = want[r["host"]]
        bound = min(1, mean + d.DEVIATIONS * (mean * (1 - mean) / (seen + 1)) ** 0.5)
        assert abs(r["mean"] - mean) < 2e-6 and abs(r["bound"] - bound) < 2e-6
        assert r["verdict"] == ("block" if bound < d.THRESHOLD else "allow")
    verdicts = {r["host"]: r["verdict"] for r in got}
    assert verdicts["bad.org"] == verdicts["a.x.co.uk"] == "block" and verdicts["good.com"] == "allow"


def test_outcomes(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, 1, None), (5, None, 0), (None, 1, 0), (6, 1, 0), (6, 0, 0)], "doc_id bigint, quality int, toxic int"
    )
    assert {r["page_id"]: r["good"] for r in d.outcomes(labels.withColumn("page_id", F.lit(1))).collect()} == {1: 1, 2: 0, 3: 0, 4: 1, 6: 0}

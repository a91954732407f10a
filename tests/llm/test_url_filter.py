import pytest

from tessera.llm import url_filter
from tessera.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, host int, rule string, lower string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "r", "l") for r in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "page_id long, good int")


def test_parts_and_rules(spark):
    rows = {1: ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
            2: ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
            3: ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
            4: ("http://x.com/fr/1://y", "x.com", "/fr/1://y", "com/fr/", "allow"),
            5: ("ftp://x.com/de/", "x.com", "/de/", "com/de/", "block"),
            6: ("http://org?x", "org", "", None, "allow"),
            7: (None, "", "", None, "allow"), 8: ("no scheme/de/", "", "", None, "allow"), 9: ("", "", "", None, "allow"),
            10: ("http://h.net#/de/" + "x" * 100_000, "h.net", "", None, "allow"), 11: ("a://b\nc://d/e", "b\nc:", "//d/e", None, "allow")}
    got = url_filter.filter_urls(pages(spark, [(i, v[0]) for i, v in rows.items()]), labels(spark, [(None, 1)]), URL_RULES)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: v[1:] for i, v in rows.items()}
    assert url_filter.filter_urls(pages(spark, [(1, "a://b")]).limit(0), labels(spark, [(1, 1)]), URL_RULES).collect() == []


def test_posterior_means_by_hand(spark):
    """The shrinkage chain for a small table, computed in plain Python."""
    seen = {"a.x.net": [1] * 8 + [0] * 2, "b.x.net": [0] * 30, "y.net": [1] * 20, "q.z.info": [1, 0]}
    rows, marks = [], []
    for host, good in seen.items():
        for g in good:
            rows.append((len(rows), f"http://{host}/p"))
            marks.append((len(rows) - 1, g))
    rows.append((len(rows), "http://new.x.net/"))
    rows.append((len(rows), "http://new.host.org2/"))
    got = {r.host: r for r in url_filter.host_reputation(pages(spark, rows), labels(spark, marks)).collect()}

    def up(groups, prior):
        """key -> (good, n) and its parent's mean; the shrunk means and k."""
        known = [(g, n, prior[p]) for g, n, p in groups.values() if n]
        spread = sum(n * (g / n - m) ** 2 for g, n, m in known)
        noise, room = sum(m * (1 - m) for _, _, m in known), sum((n - 1) * m * (1 - m) for _, n, m in known)
        k = 1 / min(max((spread - noise) / room if room else .001, .001), .5) - 1
        return {x: (k * prior[p] + g) / (k + n) for x, (g, n, p) in groups.items()}, k

    hosts = {h: (sum(g), len(g)) for h, g in seen.items()} | {"new.x.net": (0, 0), "new.host.org2": (0, 0)}
    tail = lambda h, n: ".".join(h.split(".")[-n:])
    fold = lambda n, m: {tail(h, n): (sum(v[0] for x, v in hosts.items() if tail(x, n) == tail(h, n)),
                                      sum(v[1] for x, v in hosts.items() if tail(x, n) == tail(h, n)),
                                      tail(h, m) if m else "") for h in hosts}
    total = [sum(v[i] for v in hosts.values()) for i in (0, 1)]
    suffixes, _ = up(fold(1, 0), {"": (total[0] + 1) / (total[1] + 2)})
    domains, _ = up(fold(2, 1), suffixes)
    means, k = up({h: (*v, tail(h, 2)) for h, v in hosts.items()}, domains)
    for h, (_, n) in hosts.items():
        assert got[h].mean == pytest.approx(means[h])
        assert got[h].upper == pytest.approx(means[h] + 1.645 * (means[h] * (1 - means[h]) / (k + n + 1)) ** .5)
    verdict = {r.host: r.verdict for r in url_filter.filter_urls(pages(spark, rows), labels(spark, marks), URL_RULES).collect()}
    assert verdict["b.x.net"] == "block" and verdict["y.net"] == "allow"


def test_suffixes_of_several_labels(spark):
    from pyspark.sql import functions as F
    known = ["co.uk", "uk.com", "a.co.uk", "io"]
    want = {"m.bad.co.uk": ("bad.co.uk", "co.uk"), "bad.co.uk": ("bad.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
            "x.y.a.co.uk": ("y.a.co.uk", "a.co.uk"), "notco.uk": ("notco.uk", "uk"), "z.github.io": ("github.io", "io"),
            "w.example.com": ("example.com", "com"), "": ("", "")}
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    got = hosts.select("host", url_filter.registered_domain(F.col("host"), known).alias("d"),
                       url_filter.suffix(F.col("host"), known).alias("s")).collect()
    assert {r.host: (r.d, r.s) for r in got} == want
    # a new host of bad.co.uk takes after it, one of a stranger under the same suffix does not
    rows = [(i, f"http://m.bad.co.uk/{i}") for i in range(60)] + [(100 + i, f"http://w.good.co.uk/{i}") for i in range(60)]
    marks = [(i, 0 if i < 100 else 1) for i, _ in rows]
    rows += [(998, "http://new.bad.co.uk/"), (999, "http://new.good.co.uk/")]
    mean = lambda known: {r.host: r.mean for r in url_filter.host_reputation(
        pages(spark, rows), labels(spark, marks), suffixes=known).collect()}
    apart, pooled = mean(["co.uk"]), mean([])
    assert apart["new.good.co.uk"] - apart["new.bad.co.uk"] > 0.2
    assert pooled["new.good.co.uk"] == pytest.approx(pooled["new.bad.co.uk"])

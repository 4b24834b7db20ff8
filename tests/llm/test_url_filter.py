"""URL rules against a plain re-implementation; trees on labelled urls; edge cases."""

import math
import random

from pyspark.sql import functions as F

from quarry.llm import url_filter as uf
from quarry.llm.queries import URL_RULES
from quarry.session import table


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule, verdict in URL_RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "http://example.net/en", "http://example.net/EN/", "http://net/x",
    "http://a.net?x=/y", "http://internet/x", "http://example.com/de/1", "https://m.example.com/de/", "http://notexample.com/de/",
    "http://x.org/fr/a?b=c&d=e#f", "http://x.org/en/a://b", "ftp://É.net/ü#q", "a://b://c.net/d", "http://x.net\n/de/",
]


def test_rules_equal_brute_force(spark):
    rows = [(i, u, "k") for i, u in enumerate(URLS)] + [(None, URLS[4], "k"), (4, URLS[4], "k"), (99, "http://x.com/" + "a/" * 20_000, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = uf.judge(pages, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = rows[-1][1] if r.page_id == 99 else URLS[r.page_id if r.page_id is not None else 4]
        host, path, rule, verdict = brute(url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_whole_table_rules(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    for r in uf.judge(pages, URL_RULES).collect():
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


def test_trees_learn_lexical_differences(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    rows = []
    for i in range(1500):
        bad = i % 3 == 0
        url = f"http://{word(3)}-{word(4)}-{rng.randint(100, 999)}.com/{rng.randint(10**6, 10**8)}?a=1&b=2&c={rng.randint(1, 99)}" if bad else f"http://{word(6)}.com/{word(5)}/{word(7)}"
        rows.append((i, url, int(bad)))
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int")
    seen = F.when(F.col("page_id") % 2 == 0, F.col("bad"))
    got = uf.judge(pages, [], label=seen).join(pages.select("page_id", "bad"), "page_id").filter("page_id % 2 = 1").toPandas()
    assert ((got.verdict == "block") == (got.bad == 1)).mean() > 0.97


def test_without_labels_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert [r.verdict for r in uf.judge(pages, []).collect()] == ["allow"]
    assert [r.verdict for r in uf.judge(pages, [("com/", "block")]).collect()] == ["block"]
    assert uf.judge(pages.limit(0), URL_RULES).count() == 0


def test_lexical_features_equal_brute_force(spark):
    from collections import Counter

    rows = [(i, u) for i, u in enumerate([*URLS, "http://x.com/" + "a1-/" * 3000 + "?p=1&q=2&&r#s", "http://a.b.c.d:80?x"])]
    parsed = uf.parsed(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES, "page_id", "url", None)
    for r in parsed.collect():
        url = rows[r.page_id][1] or ""
        host, path, _, verdict = brute(url)
        n = max(len(url), 1)
        query = url.split("?", 1)[1].split("#", 1)[0] if "?" in url else ""
        want = {
            "url_length": len(url), "path_length": len(path), "path_depth": path.count("/"), "host_labels": len(host.split(".")) if host else 0,
            "digit_share": sum(c in "0123456789" for c in url) / n, "hyphens": url.count("-"),
            "entropy": -sum(k / n * math.log2(k / n) for k in Counter(url).values()), "n_params": len(query.split("&")) if query else 0, "has_fragment": int("#" in url),
        }
        for name, value in want.items():
            assert math.isclose(r[name], value, rel_tol=1e-9, abs_tol=1e-9), (url[:50], name)
        assert (r.label, r.last_label) == (None if verdict is None else float(verdict == "block"), host.split(".")[-1])
        assert r.last_two == ".".join(host.split(".")[-2:])


def test_suffix_statistics_are_out_of_fold(spark):
    urls = [f"http://{h}.example.net/{k}" for h in "abcdefgh" for k in range(3)] + ["http://z.example.net/free", "http://other.org/x"]
    label = F.when(F.col("page_id") < 24, (F.col("page_id") % 2).cast("int"))
    rows = uf.parsed(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), [], "page_id", "url", label)
    got = uf.with_suffix_statistics(rows, uf.suffix_counts(rows), 0.5).collect()
    known = [r for r in got if r.label is not None]
    for r in got:
        others = [k for k in known if k.last_two == r.last_two and (r.label is None or k.fold != r.fold)]
        assert math.isclose(r.last_two_n, math.log1p(len(others)), abs_tol=1e-9)
        assert math.isclose(r.last_two_share, (sum(k.label for k in others) + 5) / (len(others) + 10), rel_tol=1e-9)

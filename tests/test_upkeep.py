"""Headed links, wildcard postings, Turtle, backfill in place and binary rounding: brute force, round trips, edge cases."""

import glob
import math
import os
import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quarry.functions import maths, text
from quarry.operators import facetmap, headings, triples, turtle, wildcards
from quarry.sources import backfill

# --- headed links ---


class Outline(HTMLParser):
    """The tag stream read by a parser: the links of each heading."""

    def __init__(self, prefix):
        super().__init__()
        self.prefix, self.category, self.said, self.href, self.out = prefix, None, None, None, []

    def handle_starttag(self, tag, attrs):
        if tag == "h2":
            self.category, self.said = None, ""
        elif tag == "a":
            self.href, self.link = dict(attrs).get("href", ""), ""

    def handle_endtag(self, tag):
        if tag == "h2":
            self.category, self.said = " ".join(self.said.split()), None
        elif tag == "a" and self.href is not None:
            slug = self.href.rstrip("/").split("/")[-1]
            if self.category and self.href.startswith(self.prefix) and slug and self.link.strip():
                self.out.append((self.category, slug))
            self.href = None

    def handle_data(self, data):
        if self.said is not None:
            self.said += data
        if self.href is not None:
            self.link += data


def outline(page):
    parser = Outline("/tasks/")
    parser.feed(page or "")
    first = {}
    for i, (category, slug) in enumerate(parser.out):
        first.setdefault(slug, (category, slug, i + 1))
    return sorted(first.values())


def test_headed_links_equal_a_parser(spark):
    rng = random.Random(5)
    parts = [
        "<h2>Vision</h2>", '<h2 class="x">Audio &amp; <b>More</b>\n x</h2>'.replace("&amp;", "and"), "<h2></h2>", "<H2>Text</H2>", "<hr>", "<p>words</p>", "<!-- <h2>No</h2><a href='/tasks/no'>no</a> -->",
        "<script>var a='<h2>No</h2>';</script>", '<a href="/tasks/image-to-text">I</a>', "<a class=x href='/tasks/asr/'>A <i>b</i></a>", '<a href="/tasks/empty"> </a>', '<a data-href="/tasks/no" href="/models/x">m</a>',
        '<a href="/tasks/t-t-s" id="1">T</a>', '<a\n href = "/tasks/long">L\n</a>', '<abbr title="x">y</abbr>', "<a>plain</a>",
    ]
    pages = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(120)] + [(900, None), (901, ""), (902, '<a href="/tasks/x">x</a>'), (903, "<h2>open"), (903, "<h2>open")]
    df = spark.createDataFrame([(i, p, "z") for i, p in pages], "page int, html string, id string")
    got = headings.headed_links(df, "page", "html").collect()
    want = sorted((i, *row) for i, p in pages for row in outline(p))
    assert sorted(tuple(r) for r in got) == want and want
    whole = headings.first_seen(headings.headed_links(df, "page", "html")).collect()
    seen = {}
    for i, category, slug, at in sorted(want, key=lambda r: (r[0], r[3])):
        seen.setdefault(slug.replace("-", " "), category)
    assert {r.task: r.category for r in whole} == seen
    assert headings.headed_links(df.limit(0), "page", "html").count() == 0


def test_headed_links_of_a_long_page(spark):
    page = "<h2>Many</h2>" + "".join(f'<a href="/tasks/t{i % 5000}">x</a>' for i in range(20000)) + "<a " * 20000
    df = spark.createDataFrame([(1, page)], "page int, html string")
    assert headings.headed_links(df, "page", "html").agg(F.count("*"), F.max("position")).first()[:] == (5000, 5000)


# --- wildcards ---


def test_wildcards_equal_every_value_tried(spark, tmp_path):
    rng = random.Random(3)
    values = ["".join(rng.choices("abAB_%\\.x*", k=rng.randint(0, 9))) for _ in range(400)] + ["ab\nab", "äbÄbab", None, "", "aba", "aba"]
    df = spark.createDataFrame([(i, v, "q") for i, v in enumerate(values)], "k int, v string, value string")
    index = wildcards.build(df, "k", "v", str(tmp_path / "w"))
    patterns = ["*aba*", "ab?b*", "*a_b*", "*%*", "?", "", "*", "*b\\.*", "AB*ab", "*äb*", "abab*bab", "*zzz*", "a*", "*ab?ab*"]

    def fits(pattern, value):
        return re.fullmatch("".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern.lower()), value.lower(), re.S)

    want = sorted((p, i) for p in patterns for i, v in enumerate(values) if v is not None and fits(p, v))
    assert sorted(tuple(r) for r in wildcards.search(index, [*patterns, "*aba*"]).collect()) == want
    assert wildcards.search(index, []).count() == 0
    empty = wildcards.build(df.limit(0), "k", "v", str(tmp_path / "e"))
    assert wildcards.search(empty, patterns).count() == 0


def test_wildcard_plan_reads_postings(spark, tmp_path):
    df = spark.createDataFrame([(i, f"author {i}") for i in range(50)], "k int, v string")
    found = wildcards.search(wildcards.build(df, "k", "v", str(tmp_path / "w")), ["*hor 7*"])
    plan = found._jdf.queryExecution().toString()
    assert "In(gram" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert [r.id for r in found.collect()] == [7]


# --- Turtle ---


def test_turtle_comes_back(spark, tmp_path):
    iri = "http://a.example/x#"
    odd = ['q"q', "back\\slash", "two\nlines\r\t", "<b> ; . , {x}", "äß 漢 😀", "\\u0041", "@prefix n0: <x> .", "", "x" * 100_000]
    rows = [(f"{iri}s{i % 7}", f"{iri}p{i % 3}", o, False) for i, o in enumerate(odd * 3)]
    rows += [(f"{iri}hot", f"{iri}p", f"value {i}", False) for i in range(3000)]  # one subject in several files
    rows += [("http://b.example/1", "http://b.example/is", o, True) for o in ("http://c.example/a_b", "http://c.example/9", 'http://c.example/<"{}|^`\\>', "urn:x", f"{iri}s1")]
    rows += [(f"{iri}s1", f"{iri}p1", f"{iri}s1", False), (f"{iri}s1", f"{iri}p1", f"{iri}s1", True)]
    df = spark.createDataFrame([(*r, 1) for r in rows + rows[:50]] + [(None, "p", "o", True, 1), ("s", "p", None, False, 1)], "s string, p string, o string, o_is_iri boolean, value int")
    turtle.write_turtle(df, str(tmp_path / "t"), file_bytes=40_000, most=2)
    files = glob.glob(f"{tmp_path}/t/part-*")
    assert len(files) > 3
    for f in files:
        with open(f) as lines:
            said = lines.read()
        assert not said or (said.startswith("@prefix n0: ") and said.endswith("\n.\n"))
    assert sum("n0:hot " in open(f).read() for f in files) > 1
    back = [tuple(r) for r in turtle.read_turtle(spark, str(tmp_path / "t")).collect()]
    assert sorted(back) == sorted(set(rows))


def test_turtle_of_no_triples(spark, tmp_path):
    none = triples.to_triples(spark.createDataFrame([], "id string, name string"), "id", {"name": "http://a.example/n"})
    turtle.write_turtle(none, str(tmp_path / "t"))
    assert turtle.read_turtle(spark, str(tmp_path / "t")).count() == 0


# --- backfill ---


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/rows/bucket=*/*.parquet")}


def by_bucket(path):
    out = {}
    for f, t in files_of(path).items():
        out.setdefault(int(re.search(r"bucket=(\d+)", f)[1]), set()).add((os.path.basename(f), t))
    return out


def test_backfill_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(str(i), f"text {i}", None if i % 4 else [1.0]) for i in range(200)]
    backfill.create(spark.createDataFrame(rows, "id string, text string, vector array<double>"), path, "id", 16, {"model": "string"})
    before = by_bucket(path)
    new = [("1", [5.0], "m"), ("2", [6.0], None), ("4", [7.0], "m"), ("2", [9.0], "a"), ("none", [1.0], "m"), (None, [1.0], "m"), ("3", None, None)]
    done = backfill.backfill(spark, path, spark.createDataFrame(new, "id string, vector array<double>, model string"))
    after = by_bucket(path)
    changed = {b for b in before if before[b] != after[b]}
    assert changed == set(done.buckets) and 1 <= len(changed) <= 2 < len(before)
    assert (done.status, done.processed, done.skipped, done.unknown) == ("success", 2, 198, 1)
    got = {r.id: (r.text, r.vector, r.model) for r in backfill.rows_of(spark, path).collect()}
    want = {i: (t, v, None) for i, t, v in rows} | {"1": ("text 1", [5.0], "m"), "2": ("text 2", [6.0], None)}
    assert got == want
    again = backfill.backfill(spark, path, spark.createDataFrame(new, "id string, vector array<double>, model string"))
    assert (again.processed, again.buckets) == (0, ()) and by_bucket(path) == after


def test_backfill_replaces_if_asked(spark, tmp_path):
    path = str(tmp_path / "t")
    backfill.create(spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 4)], "id string, v int"), path, "id", 4, {"w": "int"})
    done = backfill.backfill(spark, path, spark.createDataFrame([("a", 9, None), ("b", 8, 7)], "id string, v int, w int"), skip_existing=False)
    assert (done.processed, done.skipped, done.unknown) == (3, 1, 0)
    got = sorted(((r.id or "", r.v or 0, r.w) for r in backfill.rows_of(spark, path).collect()), key=str)
    assert got == [("", 4, None), ("a", 9, None), ("a", 9, None), ("b", 8, 7)]


def test_backfill_without_table_or_column(spark, tmp_path):
    new = spark.createDataFrame([("a", 1)], "id string, v int")
    assert backfill.backfill(spark, str(tmp_path / "none"), new).status == "skipped"
    backfill.create(new.limit(0), str(tmp_path / "t"), "id", 4, {})
    assert backfill.backfill(spark, str(tmp_path / "t"), new).unknown == 1
    with pytest.raises(ValueError):
        backfill.backfill(spark, str(tmp_path / "t"), new.withColumnRenamed("v", "other"))


# --- rounding ---


def test_binary_rounding_is_exact(spark):
    rng = random.Random(1)
    xs = [2.675, 1.005, 0.125, 0.375, 2.5, -2.675, 0.0, 1e-9, 0.005, 0.015, 1e15 + 0.3, 9e15, 1e300, math.inf, 5e13 + 0.125, 999.995, 0.045]
    xs += [rng.uniform(-1000, 1000) for _ in range(2000)] + [rng.randrange(1, 10**7) / 200 for _ in range(3000)] + [rng.randrange(1, 10**6) / 8 for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    for digits in (0, 1, 2, 4):
        for r in df.select("x", maths.round_binary(F.col("x"), digits).alias("r")).collect():
            assert r.r == (None if r.x is None else r.x if math.isinf(r.x) else round(r.x, digits)), (r.x, digits)


def test_count_labels_equal_plain_python(spark):
    rng = random.Random(2)

    def label(n):
        for size, unit in ((10**12, "T"), (10**9, "B"), (10**6, "M"), (1000, "K")):
            if n >= size:
                return f"{round(n / size, 2):g}{unit}"
        return str(n)

    ns = [0, 1, 999, 1000, 1005, 1015, 2675000, 999999, 999995, 1005000000, 10**15 + 5 * 10**9] + [rng.randrange(1, 10 ** rng.randint(1, 15)) for _ in range(2000)] + [rng.randrange(1, 200000) * 5 for _ in range(1000)]
    for r in spark.createDataFrame([(n,) for n in ns], "n long").select("n", text.count_label(F.col("n")).alias("s")).collect():
        assert r.s == label(r.n)


# --- facets of queries ---


def test_facets_equal_plain_python(spark):
    rng = random.Random(4)
    vocabulary = ["image", "classification", "image-net", "text", "to", "speech", "the", "apache-2.0", "models", "license", "bert", "x"]
    values = {"task": ["image classification", "text to speech", "speech", "Image"], "license": ["Apache-2.0", "speech"], "keywords": ["classification text", "bert", "", None]}
    rows = [(f, v) for f, vs in values.items() for v in vs]
    df = spark.createDataFrame([(v if f == "task" else None, v if f == "license" else None, v if f == "keywords" else None) for f, v in rows], "a string, b string, phrase string")
    known = {}
    for f, v in rows:
        if v:
            known.setdefault(v.lower(), (f, v))

    def brute(said):
        words, i, found, terms = (said or "").lower().split(), 0, set(), []
        while i < len(words):
            n = next((n for n in range(len(words) - i, 0, -1) if " ".join(words[i : i + n]) in known), 0)
            if n:
                found.add(known[" ".join(words[i : i + n])])
            elif len(words[i]) > 2 and words[i] not in ("models", "license", "task", "keywords") and words[i] not in terms:
                terms.append(words[i])
            i += n or 1
        return sorted(found), terms

    asked = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(300)] + [None, "", "IMAGE Classification"]
    queries = spark.createDataFrame(list(enumerate(asked)), "k int, words string")
    got = facetmap.map_queries(queries, "k", "words", facetmap.facet_values(df, {"task": "a", "license": "b", "keywords": "phrase"})).collect()
    assert {r.id: ([tuple(v) for v in r.facet_values], r.terms) for r in got} == {i: brute(s) for i, s in enumerate(asked)}
    none = facetmap.map_queries(queries, "k", "words", facetmap.facet_values(df.limit(0), {"task": "a"})).collect()
    assert len(none) == len(asked) and not any(r.facet_values for r in none)


def test_runs_of_words_are_not_broadcast(spark, tmp_path):
    """The runs of a small file of queries are many rows: the values are the side that is broadcast, or none is."""
    spark.createDataFrame([(i, "big red models") for i in range(50)], "k int, words string").write.parquet(str(tmp_path / "q"))
    spark.createDataFrame([("big red", "task", "Big red")], "phrase string, facet string, value string").write.parquet(str(tmp_path / "v"))
    queries, values = spark.read.parquet(str(tmp_path / "q")), spark.read.parquet(str(tmp_path / "v"))
    plan = facetmap.map_queries(queries, "k", "words", values)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and sum("BroadcastHashJoin" in j for j in joins) == 1
    assert next("BuildRight" in j and "phrase" in j for j in joins if "Broadcast" in j)

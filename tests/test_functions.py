"""Scalar building blocks against plain-Python statements of the same rules."""

import random

from pyspark.sql import functions as F

from lodestar.functions import url as U
from lodestar.functions.geo import walking_minutes
from lodestar.functions.similarity import similarity_level, with_jaro_winkler
from lodestar.functions.text import decode_entities, index_words, title_key
from lodestar.operators import links as LN


def jw_brute(s1, s2):
    l1, l2 = len(s1), len(s2)
    if not l1 or not l2:
        return 0.0
    r = max(0, max(l1, l2) // 2 - 1)
    used = [False] * l2
    hits = [False] * l1
    m = 0
    for i, c in enumerate(s1):
        for j in range(max(0, i - r), min(i + r, l2 - 1) + 1):
            if not used[j] and s2[j] == c:
                used[j] = hits[i] = True
                m += 1
                break
    if not m:
        return 0.0
    a = [s1[i] for i in range(l1) if hits[i]]
    b = [s2[j] for j in range(l2) if used[j]]
    t = sum(x != y for x, y in zip(a, b)) // 2
    w = (m / l1 + m / l2 + (m - t) / m) / 3
    if w > 0.7:
        p = 0
        while p < min(4, l1, l2) and s1[p] == s2[p]:
            p += 1
        w += p * 0.1 * (1 - w)
    return w


def test_jaro_winkler_matches_brute_force(spark):
    rnd = random.Random(7)
    alpha = "abcdé "
    pairs = [("".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 8))),
              "".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 8)))) for _ in range(400)]
    pairs += [("MARTHA", "MARHTA"), ("DWAYNE", "DUANE"), ("DIXON", "DICKSONX"), ("Café", "Cafe")]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = with_jaro_winkler(df, "a", "b", "jw").collect()
    for r in rows:
        assert abs(r.jw - jw_brute(r.a, r.b)) < 1e-12, (r.a, r.b)
    known = {(r.a, r.b): r.jw for r in rows}
    assert abs(known[("MARTHA", "MARHTA")] - 0.961111111) < 1e-6


def test_similarity_levels(spark):
    df = spark.createDataFrame([(0.79,), (0.8,), (0.99,), (1.0,), (None,)], "x double")
    got = [r.l for r in df.select(similarity_level(F.col("x")).alias("l")).collect()]
    assert got == ["low", "medium", "medium", "high", "low"]
    pairs = spark.createDataFrame([("a", None), (None, None), ("🙂b", "🙂b"), ("", "")], "a string, b string")
    assert [r.jw for r in with_jaro_winkler(pairs, "a", "b", "jw").collect()] == [None, None, 1.0, 0.0]


RESOLVED = [
    # (page url, href, link)
    ("http://a.example.com/x/y/z.html", "pa/pa1.html", "http://a.example.com/x/y/pa/pa1.html"),
    ("http://a.example.com/x/y/z.html", "/abs/p", "http://a.example.com/abs/p"),
    ("http://a.example.com/x/y/z.html", "../up", "http://a.example.com/x/up"),
    ("http://a.example.com/x/y/z.html", "./here", "http://a.example.com/x/y/here"),
    ("http://a.example.com/x/y/z.html", "..", "http://a.example.com/x/"),
    ("http://a.example.com/x/y/z.html", "../../../../g", "http://a.example.com/g"),
    ("http://a.example.com/x/y/z.html", "//other.net/p", "//other.net/p"),
    ("http://a.example.com/x/y/z.html", "?q=2", "http://a.example.com/x/y/z.html?q=2"),
    ("http://a.example.com/x/y/z.html", "x?y=1#part", "http://a.example.com/x/y/x?y=1"),
    ("http://a.example.com/x/y/z.html", "#part", None),
    ("http://a.example.com/x/y/z.html", "", None),
    ("http://a.example.com/x/y/z.html", "mailto:me@x.com", "http://mailto:me@x.com"),
    ("http://a.example.com/x/y/z.html", "www.x.com/p", "http://www.x.com/p"),
    ("http://a.example.com/x/y/z.html", "foo.edu/pa.html", "http://foo.edu/pa.html"),
    ("http://a.example.com/x/y/z.html", "HTTP://b.org/Q#f", "http://b.org/Q"),
    ("http://a.example.com", "p", "http://a.example.com/p"),
    ("http://c.org/a/b/", "a//b/../c", "http://c.org/a/b/a/c"),
    ("https://b.example.com/dir/?q=1", "page", "https://b.example.com/dir/page"),
    ("not a url", "page", None),
]


def test_resolve_link_table(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(RESOLVED)], "i int, url string, href string, want string")
    inline = df.select("i", U.resolve_link(F.col("url"), U.remove_fragment(F.col("href"))).alias("x")).collect()
    for r in inline:
        assert r.x == RESOLVED[r.i][2], RESOLVED[r.i]
    staged = {r.i: r.link for r in LN.resolve_links(df).collect()}
    assert staged == {i: r[2] for i, r in enumerate(RESOLVED) if r[2] is not None}


FOLLOWED = [
    # (url, may be followed in example.com)
    ("http://a.example.com/x.html", True), ("http://a.example.com/x.pdf", False), ("http://example.com", True),
    ("https://a.example.com/.hidden", True), ("http://a.example.com/p?x=1", False), ("http://a.example.com/p#f", False),
    ("ftp://example.com/", False), ("http://badexample.com/", False), ("http://a.example.com/a.b/c", True),
    ("http://a b.example.com/x", True), ("http://example.com:80/x", False), ("http://u@example.com/", False),
    ("mailto:x.example.com", False), ("", False), (None, False), ("http://a.example.com/x.HTML", False),
    (U.ARCHIVE_PREFIXES[1] + "/x.html", False),
]


def test_follow_filter_table(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(FOLLOWED)], "i int, u string")
    for r in df.select("i", U.ok_to_follow(F.col("u"), "example.com").alias("ok")).collect():
        assert r.ok == FOLLOWED[r.i][1], FOLLOWED[r.i]
    for r in LN.follow_flags(df, "example.com", "u").collect():
        assert r.ok == FOLLOWED[r.i][1], FOLLOWED[r.i]


def test_character_references(spark):
    cases = [("a&amp;b &#65;&#x1F642;&eacute;&nosuch; &copy;", "a&b A🙂é&nosuch; ©"), ("plain", "plain"), ("&", "&"),
             ("&amp;lt;", "&lt;"), ("a&nbsp;b", "a b"), ("&#0;&#xD800;", "&#0;&#xD800;"), (None, None), ("", "")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    for r in df.select("i", decode_entities(F.col("t")).alias("x")).collect():
        assert r.x == cases[r.i][1], cases[r.i]


def test_index_words_rules(spark):
    text = "The Quick brown fox: jumps!! over the LAZY dog. and . a"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(index_words(F.col("t")).alias("w")).first().w
    expected = []
    for w in text.split():
        w = w.lower()
        if w[-1] in "!.:":
            w = w[:-1]
        if w and w not in ("the", "and", "a"):
            expected.append(w)
    assert got == expected


def test_title_key(spark):
    df = spark.createDataFrame([("  CMSC 12100. Computer Science  ",)], "t string")
    assert df.select(title_key(F.col("t")).alias("k")).first().k == "CMSC 12100"


def test_walking_minutes(spark):
    df = spark.createDataFrame([(-87.6, 41.79, -87.6, 41.79), (-87.6, 41.79, -87.59, 41.79)],
                               "a double, b double, c double, d double")
    got = [r.w for r in df.select(walking_minutes(*[F.col(c) for c in "abcd"]).alias("w")).collect()]
    assert got[0] == 0 and got[1] == 13

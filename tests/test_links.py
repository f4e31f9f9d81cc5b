"""Crawl: breadth-first order, budget and failed fetches against a FIFO
queue written in plain Python."""

from collections import deque

from pyspark.sql import functions as F

from lodestar.operators import links as LN

DOMAIN = "example.com"


def bfs_brute(edges, pages, seed, ok, budget):
    out, seen = [], {seed}
    q = deque([seed]) if seed in pages and ok(seed) else deque()
    while q and (budget is None or len(out) < budget):
        u = q.popleft()
        out.append(u)
        for _, v in sorted((p, v) for (s, p, v) in edges if s == u):
            if v not in seen and ok(v) and v in pages:
                seen.add(v)
                q.append(v)
    return out


def test_crawl_matches_fifo_queue(spark):
    urls = [f"http://s{i}.example.com/p{i}" for i in range(12)] + ["http://x.other.org/a", "http://s1.example.com/q?x=1"]
    pages = set(urls[:-1]) - {urls[7]}            # page 7 fails to fetch
    edges = []
    for i in range(12):
        for pos, j in enumerate([(i * 5 + 1) % 14, (i + 3) % 14, (i * 2) % 14]):
            edges.append((urls[i], pos, urls[j]))

    def ok(u):
        return "example.com" in u and "?" not in u

    pages_df = spark.createDataFrame([(u,) for u in sorted(pages)], "url string")
    edges_df = spark.createDataFrame(edges, "src string, pos int, dst string")
    for budget in (None, 1, 4, 7):
        got = LN.crawl(pages_df, edges_df, urls[0], DOMAIN, max_pages=budget).orderBy("depth", "key").collect()
        assert [r.url for r in got] == bfs_brute(edges, pages, urls[0], ok, budget), budget


def test_crawl_reads_only_the_buckets_of_its_candidates(spark):
    """A chain of pages: each level has one candidate, so the anti join reads
    one bucket however long the history is; any number of buckets gives the
    same crawl."""
    n = 5
    urls = [f"http://a.{DOMAIN}/{i}" for i in range(n)]
    visited = LN.VisitedUrls(spark, 7)
    one = lambda u: spark.createDataFrame([(u,)], "url string")
    for u in urls:
        bits = one(u).agg(visited.touched()).first()[0]
        assert bin(bits).count("1") == 1
        left = visited.without(one(u), bits)
        assert left.count() == 1
        visited.add(one(u), bits)
        assert visited.without(one(u), bits).count() == 0
        assert {r.bucket for r in visited.read(bits).collect()} == {bits.bit_length() - 1}
    pages = spark.createDataFrame([(u,) for u in urls] + [(None,)], "url string")
    edges = spark.createDataFrame([(urls[i], 0, urls[j]) for i in range(n) for j in (i + 1, 0, i) if j < n] + [(None, 0, None)], "src string, pos int, dst string")
    for buckets in (1, 5):
        got = LN.crawl(pages, edges, urls[0], DOMAIN, buckets=buckets).collect()
        assert sorted((r.depth, r.url) for r in got) == list(enumerate(urls))
    assert LN.crawl(pages, edges, urls[0], DOMAIN, max_depth=2).count() == 3
    assert LN.crawl(pages, edges, "http://elsewhere.org/", DOMAIN).count() == 0
    assert LN.crawl(pages.limit(0), edges.limit(0), urls[0], DOMAIN).count() == 0


def test_link_extraction_and_resolution(spark):
    html = '<p><a href="/a#frag">A</a><abbr href="/no"></abbr><A class="x" HREF="b.html">B</A><a name="n">N</a></p>'
    pages = spark.createDataFrame([(1, "http://s.example.com/dir/page.html", html)], "page_id long, url string, html string")
    links = LN.resolve_links(LN.extract_links(pages)).orderBy("pos").collect()
    assert [(r.pos, r.link) for r in links] == [(0, "http://s.example.com/a"), (1, "http://s.example.com/dir/b.html")]
    flags = LN.follow_flags(LN.resolve_links(LN.extract_links(pages)), DOMAIN).select(F.min("ok")).first()[0]
    assert flags is True


def test_anchors_in_all_forms(spark):
    html = """<!-- <a href="no1"> --><script>var a='<a href="no2">'</script><a data-href="x1" href="y1">A</a>
        <A class='q' HREF='b.html?x=1&amp;y=2'>B</A><a href=/c id=z>C</a><a name="n">N</a><abbr href="no"></abbr>
        <a title="see href='no3'" href="d">D</a><a
        href = "e" >E</a><a href="">F</a>"""
    pages = spark.createDataFrame([(1, "http://s.example.com/dir/p.html", html)], "page_id long, url string, html string")
    got = [(r.pos, r.href) for r in LN.extract_links(pages).orderBy("pos").collect()]
    assert got == [(0, "y1"), (1, "b.html?x=1&y=2"), (2, "/c"), (3, "d"), (4, "e"), (5, "")]
    assert LN.page_edges(pages).count() == 5


def test_budget_rows_by_ranges(spark):
    from lodestar.session import first_by

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for n in (0, 1, 17, 999, 1000, 2000):
        assert sorted(r.k for r in first_by(df, "k", n).collect()) == list(range(min(n, 1000)))

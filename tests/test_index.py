"""Word index: page blocks, postings, code mapping, checks, and the
two-level sequence grouping against a brute-force scan."""

import random

from pyspark.sql import functions as F

from lodestar.operators import index as X

PAGE = ("<html><body><nav><a href='/x'>x</a></nav><article><h1> CMSC 12100. Computer Science I</h1>"
        "<p>Students learn the basics: loops, recursion. Also: data!</p></article></body></html>")


def test_blocks_and_postings(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/c.html", PAGE)], "page_id long, url string, html string")
    blocks = X.page_blocks(pages)
    b = blocks.first()
    assert b.code == "CMSC 12100"
    post = X.text_postings(blocks, ["page_id", "code"], ["title_text", "desc_text"])
    words = sorted(r.word for r in post.collect())
    # only one trailing ! . or : is removed; a comma stays part of the word
    assert words == sorted({"computer", "science", "learn", "basics", "loops,", "recursion", "data"})


def test_code_mapping_and_checks(spark):
    postings = spark.createDataFrame([("A", "w1"), ("A", "w2"), ("B", "w1"), ("C", "w3")], "code string, word string")
    cmap = spark.createDataFrame([("A", 10), ("B", 10), ("D", 30)], "code string, id int")
    idx = X.map_codes(postings, cmap)
    assert sorted(tuple(r) for r in idx.collect()) == [(10, "w1"), (10, "w2")]
    assert [r.code for r in X.unmapped_codes(postings, cmap).collect()] == ["C"]
    q = X.index_quality(idx.unionByName(spark.createDataFrame([(10, "the")], "id int, word string")), "id").first()
    assert (q.n_rows, q.n_words, q.n_ignored, q.n_duplicates) == (3, 3, 1, 0)
    expected = spark.createDataFrame([(10, "w1", True), (10, "w3", True), (10, "the", False)],
                                     "id int, word string, should_appear boolean")
    res = {r.word: r.passed for r in X.check_expected(idx, expected).collect()}
    assert res == {"w1": True, "w3": False, "the": True}


def test_last_marker_matches_scan(spark):
    rnd = random.Random(3)
    rows = []
    for part in range(4):
        n = rnd.randint(1, 40)
        rows += [(part, t, rnd.random() < 0.2) for t in rnd.sample(range(100), n)]
    df = spark.createDataFrame(rows, "p int, t int, m boolean")
    got = {(r.p, r.t): r.g for r in X.last_marker(df, "p", "t", F.col("m"), out="g", chunk=4).collect()}
    for part in range(4):
        last = None
        for _, t, m in sorted(r for r in rows if r[0] == part):
            if m:
                last = t
            assert got[(part, t)] == last


def test_inherited_postings(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1, 1), (1, 2, 1), (1, 3, 3)],
                                 "c int, t int, g int")
    post = spark.createDataFrame([(1, 1, "h"), (1, 2, "own"), (1, 3, "h2")], "c int, t int, word string")
    got = sorted(tuple(r) for r in X.inherited_postings(rows, "c", "t", "g", post).collect())
    assert got == [(1, 1, "h"), (1, 2, "h"), (1, 2, "own"), (1, 3, "h2")]


CATALOGUE = (
    '<html><body><div class="courseblock main"><p class="courseblocktitle"><strong>CMSC 12100.  '
    'Computer Science I.  100 Units.</strong></p><p class="courseblockdesc">First course: loops and recursion!</p></div>\n'
    '<div class="courseblock main"><p class="courseblocktitle">CMSC 15100-15200. Intro Sequence.</p>'
    '<p class="courseblockdesc">Header words here.</p></div>\n  '
    '<div class="courseblock subsequence"><p class="courseblocktitle">CMSC 15100. Intro One.</p>'
    '<p class="courseblockdesc">Own text.</p></div>'
    '<div class="courseblock subsequence"><p class="courseblocktitle">CMSC 15200. Intro Two.</p>'
    '<p class="courseblockdesc">Second.</p></div>'
    '<p>break</p><div class="courseblock subsequence"><p class="courseblocktitle">CMSC 99999. Orphan.</p></div>'
    '</body></html>')


def test_course_blocks_and_sequences(spark):
    pages = spark.createDataFrame([(1, CATALOGUE)], "page_id long, html string")
    blocks = X.course_blocks(pages)
    got = [(r.kind, r.header_pos is not None, r.code) for r in blocks.orderBy("pos").collect()]
    assert got == [("main", False, "CMSC 12100"), ("main", False, "CMSC 15100"),
                   ("subsequence", True, "CMSC 15100"), ("subsequence", True, "CMSC 15200"),
                   ("subsequence", False, "CMSC 99999")]
    words = {}
    for r in X.course_postings(blocks).collect():
        words.setdefault(r.code, set()).add(r.word)
    header = {"-15200", "intro", "header", "words", "here"}          # 'sequence' is ignored
    assert words["CMSC 12100"] == {"computer", "science", "100", "first", "loops", "recursion"}
    assert words["CMSC 15100"] == header | {"one", "own", "text"}    # header block and first member share a code
    assert words["CMSC 15200"] == header | {"intro", "two", "second"}
    assert words["CMSC 99999"] == {"orphan"}                         # not adjacent to a header


def test_grouped_index_bounded_rows(spark):
    postings = spark.createDataFrame([(k, "common") for k in range(50)] + [(1, "rare"), (2, "rare")],
                                     "doc int, word string")
    rows = X.grouped_index(postings, "doc", parts=4).collect()
    common = [r for r in rows if r.word == "common"]
    assert all(len(r["keys"]) <= 25 for r in common) and len(common) >= 2
    assert sorted(k for r in common for k in r["keys"]) == list(range(50))
    assert sorted(k for r in rows if r.word == "rare" for k in r["keys"]) == [1, 2]


def test_every_block_with_nested_tags(spark):
    html = ('<article><h1>CMSC 12100. Intro one</h1><p>first <article>nested</article> tail</article>mid'
            '<article id="q"><h1 class="t">MATH 15100. Calc &amp; more</h1>second</article>')
    got = X.page_blocks(spark.createDataFrame([(1, html), (2, "no block")], "page_id long, html string")).orderBy("block_no").collect()
    assert [(r.page_id, r.code, r.title_text.strip()) for r in got] == [(1, "CMSC 12100", ". Intro one"), (1, "MATH 15100", ". Calc & more")]
    assert got[0].desc_text.split() == ["first", "nested", "tail"] and got[1].desc_text.split() == ["second"]


def test_course_block_attributes_in_any_order_and_inner_divs(spark):
    html = ('<div id="w"><div id="i" class="courseblock main"><p x=1 class="courseblocktitle"><b>CMSC 12100-12200. Seq</b></p>'
            '<div>inner</div><p class="courseblockdesc">Desc one.</p></div> <div class=\'courseblock subsequence\'>'
            '<p class="courseblocktitle">CMSC 12100. Part</p><div><p class="courseblockdesc">Sub desc</p></div></div>text'
            '<div class="courseblock subsequence"><p class="courseblocktitle">ORPH 1</p></div></div>')
    got = X.course_blocks(spark.createDataFrame([(2, html)], "page_id long, html string")).orderBy("pos").collect()
    assert [(r.kind, r.header_pos is not None, r.code, r.desc_text) for r in got] == [
        ("main", False, "CMSC 12100", "Desc one."), ("subsequence", True, "CMSC 12100", "Sub desc"), ("subsequence", False, "ORPH 1", "")]


def test_comments_and_scripts_open_no_blocks(spark):
    """A commented-out article is no block, a script string that holds one opens none, and an unclosed comment hides the rest."""
    pages = spark.createDataFrame([
        (1, "<!-- <article><h1>CODE100 old</h1>gone</article> --><article><h1>CODE200 New</h1>kept</article>"),
        (2, "<script>var a = '<article><h1>CODE300 js</h1>';</script><nav>menu</nav><article><h1>CODE400 Real</h1>text<style>p{}</style></article>"),
        (3, "<article><h1>CODE500 <!-- x </h1> -->T</h1>a <script>'</article>'</script> b</article>"),
        (4, "<!-- <script> --><article><h1>CODE600 S</h1>s</article><!-- </script> -->"),
        (5, "<article><h1>CODE700 U</h1>u</article><!-- <article><h1>CODE800 V</h1>v</article>")], "page_id int, html string")
    got = {(r.page_id, r.block_no, r.code, r.title_text.strip(), " ".join(r.desc_text.split())) for r in X.page_blocks(pages, key_width=7).collect()}
    assert got == {(1, 0, "CODE200", "New", "kept"), (2, 0, "CODE400", "Real", "text"), (3, 0, "CODE500", "T", "a b"),
                   (4, 0, "CODE600", "S", "s"), (5, 0, "CODE700", "U", "u")}


def test_bitmaps_hold_ids_of_any_sign(spark):
    import random

    from lodestar.operators import bitmaps as B

    rng = random.Random(1)
    ids = [0, 1, -1, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, -32767, -32768, -32769, 10**12, -10**12] + [rng.randrange(-10**5, 10**5) for _ in range(300)]
    rows = [(i, w) for i in ids for w in "abc" if rng.random() < 0.6] + [(1, "a"), (1, "b"), (1, "a"), (None, "a"), (5, None)]
    maps = B.word_bitmaps(spark.createDataFrame(rows, "id bigint, word string"), "id")
    has = {w: {i for i, x in rows if x == w and i is not None} for w in "abcd"}
    for terms in (["a"], ["a", "b"], ["a", "b", "c", "a"], ["a", "d"], ["d"]):
        got = [r.id for r in B.bitmap_ids(B.all_terms_bitmap(maps, terms), "id").collect()]
        assert sorted(got) == sorted(set.intersection(*(has[t] for t in terms)))
        got = [r.id for r in B.bitmap_ids(B.any_term_bitmap(maps, terms), "id").collect()]
        assert sorted(got) == sorted(set.union(*(has[t] for t in terms)))
    assert B.bitmap_ids(B.all_terms_bitmap(maps.limit(0), ["a"]), "id").count() == 0

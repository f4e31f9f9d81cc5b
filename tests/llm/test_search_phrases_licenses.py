"""Ranked search, phrases and license scans against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import collocations as C
from lodestar.llm import license_scan as L
from lodestar.llm import quotient_filter as Q
from lodestar.llm import ranked_search as R

from . import cases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ---- 11 -------------------------------------------------------------------------

def terms(text):
    return TERM.findall((text or "").translate(LOW))


def best_by_all(docs, items, k):
    docs = [(i, Counter(ts), len(ts)) for i, t in docs if i is not None and (ts := terms(t))]
    n, total = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in sorted({x for x in items if x[0] is not None and x[1] is not None}):
        got = []
        for i, c, size in docs:
            m = 75 + 25 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                got.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(got)[:k])]
    return sorted(out)


def test_ranked_equals_scoring_all(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD", 1 << 14)       # several shards per task
    monkeypatch.setattr(R, "GROUP_TERMS", 40)      # several groups of items
    rng = random.Random(3)
    rows = [r for r in cases.documents()] + [(100 + i, cases.prose(i % 40, rng.randint(1, 80)), "en", "a", 1) for i in range(300)]
    rows.append((1000, "Same same words\x00here", "en", "a", 1))
    items = [(1, cases.prose(1, 20)), (1, cases.prose(1, 20)), (2, "SAME words, words"), (3, ""), (4, None), (None, "same"), (5, "nowhere-at-all"),
             (6, cases.prose(2, 30)), (6, "one two one"), (7, "ba du ki lo stra ñé x")]
    docs = cases.table(spark, rows).selectExpr("doc_id", "text", "lang AS item_id", "n_chars AS score")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(tuple(r) for r in R.ranked(docs, asked, 5).collect())
    assert got == best_by_all([(r[0], r[1]) for r in rows], items, 5)


def test_ranked_on_empty_tables(spark):
    docs, items = cases.table(spark, []), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert R.ranked(docs, items).collect() == []
    assert R.ranked(cases.table(spark), items.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_max_score_reads_few_blocks(seed):
    """The shard search against adding up every posting; rare terms keep most blocks of common ones closed."""
    rng = np.random.default_rng(seed)
    n, k = 20_000, 10
    m = rng.integers(80, 400, n)
    every, weights = [], []
    for size, w in ((n, 40), (n // 2, 300), (n // 8, 900), (300, 5000), (40, 7000), (1, 9000)):
        doc = np.sort(rng.choice(n, size, replace=False)).astype(np.int64)
        tf = np.minimum(rng.geometric(0.6, size), 70_000)
        tf[rng.integers(0, size)] = 66_000
        every.append((doc, tf))
        weights.append(w)
    edge = np.cumsum([0] + [len(d) for d, _ in every])
    doc, tf = (np.concatenate(x) for x in zip(*every))
    factor = R.tf_factor(tf, m[doc])
    made = R.Postings(edge, doc, tf, factor)
    lists = [R.PostingList(len(d), int(factor[a:b].max()), *made.row(i)) for i, ((d, _), a, b) in enumerate(zip(every, edge, edge[1:]))]
    for one, (d, t) in zip(lists, every):
        for own, back in zip((d, t), one.read(np.arange(len(one.last)))):
            assert (own == back).all()
    score = np.zeros(n, np.int64)
    for (d, t), w in zip(every, weights):
        score[d] += w * R.tf_factor(t, m[d])
    expected = np.lexsort((np.arange(n), -score))[:k]
    read = []
    got, points = R.search(lists, weights, m, k, read)
    assert got.tolist() == expected.tolist() and points.tolist() == score[expected].tolist()
    assert sum(a for a, _ in read) < sum(b for _, b in read) / 2


def test_search_keeps_ties_in_order():
    doc = np.arange(500, dtype=np.int64)
    m = np.full(500, 100)
    made = R.Postings(np.array([0, 500, 1000]), np.concatenate([doc, doc]), np.ones(1000, np.int64), np.full(1000, 10**9 // 2200))
    lists = [R.PostingList(500, 10**9 // 2200, *made.row(i)) for i in range(2)]
    assert R.search(lists, [3, 1], m, 4)[0].tolist() == [0, 1, 2, 3]


# ---- 12 -------------------------------------------------------------------------

def words(text):
    return WORD.findall((text or "").translate(LOW))


def base_of(text):
    ws = words(text)
    at = [(i, label) for phrase, label in L.PHRASES for i in range(len(ws)) if ws[i:i + len(phrase.split())] == phrase.split()]
    places = [a for a, _ in at]
    return len(ws), len(at), min(places, default=None), max(places, default=None), sorted({x for _, x in at})


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def spans_of(text, k=3, drift=4, votes=0.4, least=0.85):
    ws, good = words(text), []
    for t, (_, template) in enumerate(L.TEMPLATES):
        tw = words(template)
        grams = {}
        for i in range(len(tw) - k + 1):
            grams.setdefault(tuple(tw[i:i + k]), []).append(i)
        diagonals = Counter(p - i for p in range(len(ws) - k + 1) for i in grams.get(tuple(ws[p:p + k]), ()))
        spans = []
        for d in sorted(diagonals):
            if spans and d - spans[-1][1] <= drift:
                spans[-1][1] = d
                spans[-1][2] += diagonals[d]
            else:
                spans.append([d, d, diagonals[d]])
        for low, high, n in spans:
            start, end = max(0, low), min(len(ws), high + len(tw))
            common = longest(tw, ws[start:end])
            share = common / max(len(tw), end - start)
            if n >= max(1, math.ceil(votes * (len(tw) - k + 1))) and share >= least:
                good.append((-share, -common, t, start, end))
    taken = []
    for share, _, t, start, end in sorted(good):
        if all(end <= a or start >= z for a, z, _, _ in taken):
            taken.append((start, end, L.TEMPLATES[t][0], -share))
    return sorted(taken)


def licensed():
    mit, apache = L.TEMPLATES[2][1], L.TEMPLATES[4][1]
    return [
        (1, "Notes. " + mit + " and more words"), (2, mit.replace("free of charge", "wholly free of any charge").upper()),
        (3, "x " * 500 + apache.replace("in compliance", "compliance") + " y" * 300 + "\n" + mit), (4, "Licensed under the Foo License"),
        (5, L.TEMPLATES[14][1] + ". " + L.TEMPLATES[13][1]), (6, "the the the the license license the license"), (7, "Released under the\nMIT  License!"),
        (8, "mit_license GNU General\tPublic-License; cc by cc by"), (9, cases.prose(9, 70_000) + " " + apache), (9, "apache license"),
        (None, mit), (None, mit), (10, None), (11, ""), (12, "Licensed under CC BY-NC 4.0, version of the mit license"), (13, "ümit license über"),
    ]


def test_licenses_equal_brute_force(spark):
    rows = [(i and i + 100, t) for i, t in licensed()] + [(r[0], r[1]) for r in cases.documents()]
    docs = spark.createDataFrame([(i, t, 3, "z") for i, t in rows], "doc_id bigint, text string, n_words int, spans string")
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], sorted(r["base"]),
            [(s["start"], s["end"], s["label"], s["share"]) for s in r["spans"]]) for r in L.scan_licenses(docs).collect()]
    expected = [(i, *base_of(t), spans_of(t)) for i, t in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    by = {i: [s[2] for s in x] for i, *_, x in got}
    assert by[101] == by[102] == ["mit"] and by[103] == ["apache-2.0", "mit"] and by[104] == [] and by[112] == ["cc-by-nc-4.0"]


def test_license_query_counts_the_phrases_of_its_contract(spark, tmp_path):
    """The phrases are spelled out here: "general public license" alone is none of them."""
    wanted = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    texts = ["the general public license", "GNU General-Public\nLICENSE, general public license; gnu gnu general public license",
             "gnu lesser general public license", "mit license cc by", "gnu general public", "CC BY apache license", None]
    spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
           for r in L.op12_license_scan(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ws = words(text)
        at = [(j, x) for p, x in wanted.items() for j in range(len(ws)) if ws[j:j + len(p.split())] == p.split()]
        places = [a for a, _ in at]
        assert got[i] == (len(ws), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))
    assert got[0][1] == got[2][1] == 0 and got[1][1:4] == (2, 0, 8)


def test_license_parts_do_not_matter(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b " * 40 + L.TEMPLATES[9][1] + " c" * 50)], "doc_id bigint, text string")
    whole = L.scan_licenses(docs).collect()
    monkeypatch.setattr(L, "PART", 7)
    assert [r["label"] for r in whole[0]["spans"]] == ["bsd"] and L.scan_licenses(docs).collect() == whole


def test_license_query_on_empty_table(spark):
    assert L.scan_licenses(cases.table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        L.scan_licenses(cases.table(spark), templates=(("x", "two words"),))


def test_common_words_against_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert L.common_words(a, b) == longest(a, b)


# ---- 13 -------------------------------------------------------------------------

def phrases(rows, longest_=5, least=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + k])) for k in range(1, longest_ + 1) for i in range(len(ws) - k + 1))
    often = {x: c for x, c in f.items() if c >= least}
    many = {x: c for x, c in often.items() if len(x[1]) > 1}
    cover = Counter()
    for (lang, g), c in many.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                cover[lang, g[i:i + k]] = max(cover[lang, g[i:i + k]], c)
    out = []
    for (lang, g), a in many.items():
        if cover[lang, g] < a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]])
                                 for k in range(1, len(g)))
            out.append((lang, " ".join(g), a, l, r, n[lang], score))
    return sorted(out)


@pytest.mark.parametrize("flush", [1 << 20, 50])
def test_collocations_equal_counting_all(spark, monkeypatch, flush):
    monkeypatch.setattr(C, "FLUSH", flush)
    monkeypatch.setattr(C, "RANGE", 1 << 10)
    monkeypatch.setattr(C, "BLOCK", 1 << 12)
    rng = random.Random(8)
    rows = [(r[1], r[2]) for r in cases.documents()]
    rows += [(" ".join(rng.choices(["New", "york", "city", "hall", "of", "records", "a.", "b,c"], k=rng.randint(0, 60))), rng.choice(["en", None, "und"]))
             for _ in range(150)]
    rows += [("New York city hall of records", "en")] * 40
    docs = spark.createDataFrame([(t, g, 1, 2) for t, g in rows], "text string, lang string, n int, f int")
    got = sorted(tuple(r) for r in C.collocations(docs, min_count=30).collect())
    assert got == phrases(rows, least=30) and len(got) > 40


def test_rows_of_blocks_stay_small(spark):
    """Of any number of texts; the counts don't depend on the blocks."""
    docs = spark.createDataFrame([(" ".join(f"w{i % 97}x{j}" for j in range(4000)), "en") for i in range(60)], "text string, lang string")
    rows = C.token_blocks(docs.select("lang", "text").coalesce(1), 0).collect()
    assert sum(sum(r["counts"]) for r in rows) == 60 * 4000
    assert max(len(r["tokens"]) + 16 * len(r["words"]) + sum(map(len, r["words"])) for r in rows) < 1 << 21


def test_colliding_word_hashes_are_seen(spark, monkeypatch):
    """Hashes of a few bits at first, then another seed with whole ones."""
    docs = spark.createDataFrame([("a b c d", "en")] * 9 + [("e f g h", "en")] * 2, "text string, lang string")
    whole = C.word_ids
    monkeypatch.setattr(C, "word_ids", lambda w, lang, seed: whole(w, lang, seed) if seed else whole(w, lang, 0) & np.uint64(3 << 30))
    got = [tuple(r) for r in C.collocations(docs, min_count=5).collect()]
    assert got == phrases([("a b c d", "en")] * 9 + [("e f g h", "en")] * 2, least=5)


def test_collocations_on_empty_table(spark):
    assert C.collocations(cases.table(spark, [])).collect() == []


@pytest.mark.parametrize("k,bits", [(2, 1), (2, 7), (3, 21), (5, 13), (5, 20), (5, 37), (4, 63)])
def test_quotient_filters_lose_nothing(k, bits):
    rng = np.random.default_rng(k * bits)
    packing = Q.Packing(k, bits)
    ids = [rng.integers(0, min(1 << bits, 50 if bits > 7 else 1 << bits), 4000) + ((1 << bits) - 50 if bits > 7 else 0) for _ in range(k)]
    expected = Counter(zip(*(x.tolist() for x in ids)))
    top = min(2, packing.widths[0])
    parts = {}
    for a in range(0, 4000, 1000):
        lanes, counts = packing.count(packing.permute(packing.pack([x[a:a + 1000] for x in ids])))
        counts = counts * 200
        for head, data in Q.segments(packing, lanes, counts, top):
            parts.setdefault(head, []).append(data)
    got = Counter()
    for head, filters in parts.items():
        lanes, counts = Q.merge(packing, filters, top, head)
        assert Q.encode(packing, lanes, counts, top) == Q.encode(packing, *Q.decode(packing, Q.encode(packing, lanes, counts, top), top, head), top)
        for *g, c in zip(*packing.unpack(packing.restore(lanes)), counts):
            got[tuple(int(x) for x in g)] += int(c)
    assert got == Counter({g: 200 * c for g, c in expected.items()})


def test_numbered_breaks_pieces_and_texts():
    tokens, words, counts = C.numbered(pa.array(["A b. b", "", "b\tA,", "c"], pa.large_string()))
    spelled = ["" if t == 0 else words[int(t) - 1].as_py() for t in tokens]
    assert spelled == ["", "a", "b", "", "b", "", "b", "a", "", "c"] and sorted(counts.tolist()) == [1, 2, 3]

"""Operators 1, 4 and 10, and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import main_text, ppm, toxicity

from . import cases

BAD = ["nastyword", "awfulword", "vileword"]


def labelled(n=300):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = cases.prose(1000 + i, 60).split()
        if toxic:
            for w in rng.sample(BAD, 2):
                words.insert(rng.randrange(len(words)), w.upper() if i % 2 else w + ",")
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, int(i % 7 > 0), int(toxic)))
    return rows, labels


def test_chain_catches_held_out_toxic_documents(spark):
    rows, labels = labelled()
    docs = cases.table(spark, rows)
    table = spark.createDataFrame(labels[:200] + [(5, None, None), (None, 1, 1), (99999, 1, 1)], "doc_id bigint, quality int, toxic int")
    chain = toxicity.train(docs, table, ["quality", "toxic"])
    assert len(chain.models) == 2 and len(chain.models[1].by_category) == 1
    got = {r["doc_id"]: r["p_toxic"] for r in chain.score(docs).collect()}
    wrong = [i for i, _, t in labels[200:] if (got[i] >= 0.5) != bool(t)]
    assert not wrong


def test_chain_on_awkward_rows(spark):
    rows, labels = labelled(100)
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = cases.table(spark, rows)
    chain = toxicity.train(docs, table, ["quality", "toxic"])
    odd = cases.table(spark).withColumns({"p_toxic": F.lit("clash"), "_words": F.lit(1), "extra": F.lit(2)})
    out = chain.score(odd)
    assert out.columns.count("p_toxic") == 1 and out.count() == len(cases.documents()) and "extra" in out.columns
    assert all(0 <= r["p_toxic"] < 0.5 for r in out.collect())
    assert chain.score(cases.table(spark, [])).count() == 0


def test_chain_without_labels_or_classes(spark):
    docs = cases.table(spark)
    schema = "doc_id bigint, quality int, toxic int"
    none = toxicity.train(docs, spark.createDataFrame([], schema), ["quality", "toxic"])
    assert [m.share for m in none.models] == [0.0, 0.0]
    one = toxicity.train(docs, spark.createDataFrame([(1, 1, 0), (3, 1, 0)], schema), ["quality", "toxic"])
    assert [m.share for m in one.models] == [1.0, 0.0]
    assert one.score(docs).where("p_toxic > 0").count() == 0
    assert toxicity.train(cases.table(spark, []), spark.createDataFrame([(1, 1, 0)], schema), ["toxic"]).models[0].share == 0.0


def test_newton_meets_the_gradient_condition():
    rng = np.random.default_rng(0)
    x = (rng.random((400, 5)) < 0.3).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 1, 3] - 1)))).astype(float)
    w = toxicity._newton(np.hstack([x, np.ones((400, 1))]), y, 1e-3, block=64)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.abs(x.T @ (p - y) + 1e-3 * 400 * w[:-1]).max() < 1e-3 and abs((p - y).sum()) < 1e-3


@pytest.mark.parametrize("head,order", [(1 << 19, 3), (5, 2)])
def test_ppm_matches_a_plain_trie(spark, head, order):
    rows = [(r[0], r[1][:2000] if r[1] else r[1], *r[2:]) for r in cases.documents()]
    out = (F.col("doc_id") % 3 == 1)
    docs = cases.table(spark, rows).withColumns({"score": F.lit("clash"), "tie": F.lit("clash")})
    got = ppm.language_model_scores(docs, out, order=order, head_words=head).collect()
    low = lambda t: (t or "").encode().lower()
    train = [low(r[1]) for r in rows if not (r[0] is not None and r[0] % 3 == 1)]
    counts = Counter(w for t in train for w in t.split()) + Counter({None: len(train)})
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], r[1])
    for g in got:
        t = low(texts[g["doc_id"]])
        words = t.split() + [None]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert g["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert g["score"] == pytest.approx(ppm.brute_force(train, t, order))
        assert g["held_out"] == (g["doc_id"] is not None and g["doc_id"] % 3 == 1)


def test_ppm_probabilities_add_up_to_one(spark):
    rows = cases.table(spark, [(1, "abracadabra", "", "", 1), (2, "abba\n", "", "", 1)])
    trie = ppm.trie_of(ppm.count_texts(rows.select("text"), 3).where("kind = 0"), 3, 1 << 20)
    for context in ([256, 256, 256], [97, 98, 114], [98, 98, 97], [120, 97, 98], [0, 1, 2]):
        key = (context[0] << 18 | context[1] << 9 | context[2]) << 9
        keys = np.array([key | s for s in range(257)], np.uint64)
        assert (10 ** trie.log10(keys)).sum() == pytest.approx(1.0)


def test_ppm_bounded_trie_stays_a_model(spark):
    rows = cases.table(spark, [(1, cases.prose(1, 300), "", "", 1)])
    counts = ppm.count_texts(rows.select("text"), 3).where("kind = 0")
    small = ppm.trie_of(counts, 3, 60)
    assert len(small.cells[3].keys) < len(ppm.trie_of(counts, 3, 1 << 20).cells[3].keys)
    for context in ([98, 97, 100], [256, 256, 256]):
        key = (context[0] << 18 | context[1] << 9 | context[2]) << 9
        assert (10 ** small.log10(np.array([key | s for s in range(257)], np.uint64))).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("max_nodes", [40, 300, 2000])
def test_ppm_scores_do_not_depend_on_the_held_counts(spark, max_nodes):
    rows = [(r[0], r[1][:600] if r[1] else r[1], *r[2:]) for r in cases.documents()]
    out, order = F.col("doc_id") % 3 == 1, 3
    low = lambda t: (t or "").encode().lower()
    train = [low(r[1]) for r in rows if not (r[0] is not None and r[0] % 3 == 1)]
    texts = {r[0]: low(r[1]) for r in rows}
    got = ppm.language_model_scores(cases.table(spark, rows), out, order=order, max_nodes=max_nodes).collect()
    assert len(got) == len(rows)
    for g in got:
        assert g["score"] == pytest.approx(ppm.brute_force(train, texts[g["doc_id"]], order)), g["doc_id"]


def test_ppm_without_training_rows(spark):
    got = ppm.language_model_scores(cases.table(spark, [(1, "ab", "", "", 1), (2, None, "", "", 1)]), F.lit(True), order=2).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == [(1, 0, 0), (2, 0, 0)]
    assert {round(r["score"], 6) for r in got} == {round(-math.log10(257), 6), round(-3 * math.log10(257), 6)}
    assert ppm.language_model_scores(cases.table(spark, []), F.lit(False), order=2).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>gone</p> -->{article}
<aside>Side</aside><section id="comments"><p>Nice post</p></section><form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("html,text", [
    ("", ""), ("no markup &amp; all", "no markup & all"),
    (PAGE.format(article="<article><h1>Head</h1><p>One&nbsp;two\n three<br>four<p>Five <b>six</b>seven</article>"), "Head\n\nOne two three four\n\nFive sixseven"),
    (PAGE.format(article="<main><p>x</p><div class='ad'>Buy</div><p>&#x41;&eacute;</p><script>var a = '</p>';</script></main>"), "x\n\nAé"),
    (PAGE.format(article="<article><header><h2>T</h2><p>by me</p></header><p title='a>b'>y</p><ul><li>i<li>j</ul></article>"), "T\n\ny\n\ni\n\nj"),
    ("<nav>menu<article><p>never closed menu", "never closed menu"),
    ("<p class=ad>Buy now<p>Real text", "Real text"),
    ('<div class="content has-sidebar"><article><p>Body text.</p></article><div class="sidebar">s</div></div>', "Body text."),
    ('<div class="page with-header"><div class="site-header">Top</div><article><p>Body text.</p></article></div>', "Body text."),
    ('<form action="/"><nav>menu</nav><article><p>Body text.</p></article><input></form>', "Body text."),
    ('<article><p>Before.</p><div class="share-price">Up 3 %</div><div class="share-buttons">Tweet</div></article>', "Before.\n\nUp 3 %"),
    ('<article><p>Text.</p><ul><li><a href=a>one</a><li><a href=b>two</a><li><a href=c>three</a></ul><p><a href=d>All linked.</a></p></article>', "Text."),
    ('<article><p>Text.</p><p><a href=d>A linked line.</a></p><p>More.</p></article>', "Text.\n\nA linked line.\n\nMore."),
    ('<article><p>Body text, longer than the comments are.</p></article><section id="comments"><article>me too</article></section>', "Body text, longer than the comments are."),
])
def test_main_text(html, text):
    assert main_text.main_text(html) == text


def test_main_text_without_an_article_finds_the_surge():
    body = "".join(f"<p>{'word ' * 40}{i}.</p>" for i in range(4))
    page = "<div><a href=x>one</a></div><div><a href=y>two</a></div>" * 5 + f"<div>{body}</div>" + "<div class='footer'>f</div><div>x</div>"
    assert main_text.main_text(page) == "\n\n".join("word " * 40 + f"{i}." for i in range(4))


def test_main_text_keeps_a_section_behind_an_advert():
    """A short closing section stays, however long the section before is."""
    page = f"<div><p>{'long words ' * 300}</p><div class='advert'>Buy</div><h2>The end</h2><p>Short close.</p><div class='ad'>x</div><div>next</div></div>"
    assert main_text.main_text(page).split("\n\n")[1:] == ["The end", "Short close."]


def plain_selection(lines):
    """main_text's choice among lines, restated without running sums."""
    w = [0 if 2 * k > len(t) else len(t) for t, k, _ in lines]
    def best(of):
        return max((sum(of[i:i + 3]) for i in range(len(of))), default=0)
    inside, outside = ([x if m == want else 0 for x, (_, _, m) in zip(w, lines)] for want in (True, False))
    if best(inside) and 4 * best(inside) >= best(outside):
        drop = {i + j for i in range(len(lines) - 2) for j in range(3) if all(lines[i + d][0] and lines[i + d][2] and not w[i + d] for d in range(3))}
        return [t for i, (t, _, m) in enumerate(lines) if m and t and i not in drop]
    runs, last = [], None
    for i, x in enumerate(w):
        if x:
            if last is not None and i - last <= 3:
                runs[-1].append(i)
            else:
                runs.append([i])
            last = i
    good = [r for r in runs if best([w[i] if i in r else 0 for i in range(len(w))]) >= main_text.FLOOR
            or any(lines[i][0].endswith(main_text.SENTENCE_ENDS) for i in r)]
    if runs and not good:
        good = [max(runs, key=lambda r: best([w[i] if i in r else 0 for i in range(len(w))]))]
    return [lines[i][0] for r in good for i in range(r[0], r[-1] + 1) if lines[i][0]]


def test_main_text_against_a_restatement(monkeypatch):
    rng = random.Random(6)
    for _ in range(3000):
        lines = []
        for _ in range(rng.randint(0, 14)):
            t = rng.choice(["", "", "ab", "a short line", "a line of more than twenty-five characters", "ends."])
            lines.append((t, len(t) if rng.random() < 0.4 else 0, bool(t) and rng.random() < 0.3))
        monkeypatch.setattr(main_text, "lines_of", lambda html, lines=lines: lines)
        assert main_text.main_text("") == "\n\n".join(plain_selection(lines)), lines


def test_main_text_is_not_only_the_marked_card():
    body = [f"{'word ' * 40}{i}." for i in range(4)]
    card = "<article><h3>Read next</h3><p>A short teaser.</p></article>"
    page = "<div>" + "".join(f"<p>{b}</p>" for b in body) + f"</div><nav>menu</nav>{card}"
    assert main_text.main_text(page).split("\n\n")[:4] == body
    assert main_text.main_text(f"<div>By the editors</div><article>{'<p>short</p>' * 3}</article>") == "\n\n".join(["short"] * 3)


def test_extract_on_awkward_pages(spark):
    rows = [(1, "u", None), (2, None, "<p>" * 5000 + "deep"), (3, "u", "<" * 3000), (3, "u", "<" * 3000), (None, "u", "<p>" + "z" * 200_000), (4, "u", "<!-- open <p>x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"text": F.lit(1), "extra": F.lit("e")})
    out = main_text.extract(pages)
    got = out.collect()
    assert len(got) == 6 and "extra" in out.columns and out.columns.count("text") == 1
    assert {r["page_id"]: r["n_chars"] for r in got}[None] == 200_000
    assert main_text.extract(pages.limit(0)).count() == 0


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    import corpus_pipeline

    rows, labels = labelled(100)
    rows = [(r[0] + 5000, *r[1:]) for r in rows]
    folder = str(tmp_path)
    spark.createDataFrame([(i + 5000, q, t) for i, q, t in labels], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    cases.table(spark, cases.documents() + rows).write.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "jaccard_join", "mixing", "byte_bpe"]
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and {"ids", "n_tokens"} <= set(out.columns)
    ids = {r["doc_id"] for r in out.collect()}
    toxic = {i + 5000 for i, _, t in labels if t}
    assert not ids & toxic and not ids & {2}
    empty = cases.table(spark, [])
    for name, work in corpus_pipeline.STAGES[:-1]:
        got = work(spark, empty, folder)
        assert got.columns == empty.columns and got.count() == 0, name

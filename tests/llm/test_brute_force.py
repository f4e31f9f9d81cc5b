"""The classifier chain and the whole pipeline against plain Python."""

import base64
import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import regex
import tiktoken
from pyspark.sql import functions as F

from lodestar.llm import toxicity

from . import cases, test_similarity
from .test_host_rules_and_mixing import WORD, expected_targets
from .test_models_and_pages import labelled

FOLDS, MAX_WORDS, MIN_EVIDENCE, PENALTY = 3, 256, 10.0, 3e-5


def distinct_words(text):
    return set(regex.findall(r"[\p{L}\p{N}]+", (text or "").lower()))


def telling_words(rows):
    """Words of at least two of ``rows`` (words, 0 or 1) whose documents differ
    most in class from all."""
    k, n = Counter(), Counter()
    for found, y in rows:
        n.update(found)
        k.update(found if y else ())
    share = sum(y for _, y in rows) / len(rows) if rows else 0
    if share in (0, 1):
        return []
    def half(a, expected):
        return a * math.log(a / expected) if a else 0.0
    g = {w: 2 * (half(k[w], n[w] * share) + half(n[w] - k[w], n[w] * (1 - share))) for w in n if n[w] > 1}
    return sorted((w for w in g if g[w] >= MIN_EVIDENCE), key=lambda w: (-g[w], w))[:MAX_WORDS]


def logistic(x, y):
    """Weights of a logistic model, last the intercept, by damped Newton steps
    until the gradient vanishes."""
    ridge = np.full(x.shape[1], PENALTY * len(x))
    ridge[-1] = 0
    w = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + ridge @ (w * w) / 2

    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (p - y) + ridge * w
        if np.abs(slope).max() < 1e-8:
            break
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(ridge + 1e-9), slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
    return w


def plain_chain(rows, labels, fold, n_categories):
    """Probabilities of every row by category: labels (doc_id, y...), fold by
    doc_id; later models learn from out-of-fold probabilities."""
    text = {r[0]: distinct_words(r[1]) for r in rows}
    seen = [(text[i], fold[i], y) for i, *y in labels if i in text]
    every = [distinct_words(r[1]) for r in rows]
    earlier, scores = [[] for _ in seen], [[] for _ in every]

    def model(c, at):
        y = np.array([seen[i][2][c] for i in at], float)
        vocabulary = telling_words([(seen[i][0], seen[i][2][c]) for i in at])
        if not len(y) or y.min() == y.max() or not (vocabulary or c):
            share = float(y.mean()) if len(y) else 0.0
            return lambda found, before: share
        def line(found, before):
            return [float(v in found) for v in vocabulary] + before + [1.0]
        w = logistic(np.array([line(seen[i][0], earlier[i]) for i in at]), y)
        return lambda found, before: float(1 / (1 + np.exp(-(np.array(line(found, before)) @ w))))

    for c in range(n_categories):
        whole = model(c, list(range(len(seen))))
        part = [model(c, [i for i in range(len(seen)) if seen[i][1] != f]) for f in range(FOLDS)]
        scores = [s + [whole(found, s)] for found, s in zip(every, scores)]
        earlier = [e + [part[f](found, e)] for (found, f, _), e in zip(seen, earlier)]
    return scores


def folds_of(spark, labels):
    ids = spark.createDataFrame([(r[0],) for r in labels], "i bigint")
    return {r.i: r.f for r in ids.select("i", F.pmod(F.xxhash64("i", F.lit("fold")), F.lit(FOLDS)).alias("f")).collect()}


def test_chain_equals_a_plain_chain(spark):
    rows, labels = labelled(150)
    # quality follows a word of its own, so that both models have words
    rows = [(r[0], r[1] + (" fine" if labels[i][1] and i % 9 else " poor"), *r[2:]) for i, r in enumerate(rows)]
    docs = cases.table(spark, rows)
    chain = toxicity.train(docs, spark.createDataFrame(labels[:110], "doc_id bigint, quality int, toxic int"), ["quality", "toxic"])
    assert all(m.by_word for m in chain.models)
    got = {r["doc_id"]: (r["p_quality"], r["p_toxic"]) for r in chain.score(docs).collect()}
    want = plain_chain(rows, labels[:110], folds_of(spark, labels), 2)
    for r, p in zip(rows, want):
        assert np.abs(np.subtract(got[r[0]], p)).max() < 0.02, (r[0], got[r[0]], p)


def at_most_one_edit(a, b):
    """Edits up to 1, else 2: what is left between common start and end."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return min(2, max(len(a), len(b)) - i - j)


def without_repeated_lines(rows):
    made = test_similarity.brute_lines(rows)
    out = []
    for r in rows:
        text, gone = made.get((r[0] is not None, r[0] or 0, r[1]), (r[1], 0))
        lines = sum(bool(WORD.search(x)) for x in (r[1] or "").split("\n"))
        if not gone:
            out.append(r)
        elif gone < lines:
            out.append((r[0], text, r[2], r[3], len(text)))
    return out


def first_of_near(rows, width=5):
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                group = [group[i] if g == group[j] else g for g in group]
    best = {}
    for i, r in enumerate(rows):
        place = (r[0] is None, r[0] or 0)
        if group[i] not in best or place < best[group[i]][0]:
            best[group[i]] = place, i
    return [r for i, r in enumerate(rows) if not sets[i] or best[group[i]][1] == i]


def mixed(rows):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    total, of = defaultdict(int), defaultdict(list)
    for r, n in zip(rows, size):
        total[r[3]] += n
        digest = hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest()
        of[r[3]].append((len(f"{n:b}"), digest[:4], n, r[0] is not None, r[0] or 0, r))
    targets, out = expected_targets(total), []
    for source, listed in of.items():
        start = int(hashlib.md5(("null" if source is None else "=" + source).encode()).hexdigest()[:8], 16) / 2**32
        rate = float(targets[source]) / total[source] if total[source] else 0.0
        for i, place in enumerate(sorted(listed, key=lambda x: x[:5])):
            out += [place[5]] * (math.floor(start + rate * (i + 1)) - math.floor(start + rate * i))
    return out


def test_pipeline_equals_plain_python(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(test_similarity, "edits", at_most_one_edit)
    rows, labels = labelled(70)
    rows = [(r[0] + 5000, r[1], r[2], f"s{r[0] % 4}", 1) for r in rows]
    labels = [(i + 5000, q, t) for i, q, t in labels]
    rows += [r for r in cases.documents() if r[0] != 11] + test_similarity.near_copies(7, words=400, start=9000)
    folder = str(tmp_path)
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    cases.table(spark, rows).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()

    clean = [r for r, p in zip(rows, plain_chain(rows, labels, folds_of(spark, labels), 2)) if p[1] < 0.5]
    lined = without_repeated_lines(clean)
    single = first_of_near(lined)
    assert len(rows) > len(clean) > len(lined) > len(single)  # every filter has work
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in mixed(single):
        ids = encoding.encode_ordinary(r[1] or "")
        assert encoding.decode(ids) == (r[1] or "")
        want.append((*r, ids, len(ids)))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))

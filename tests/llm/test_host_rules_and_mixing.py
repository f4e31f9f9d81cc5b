"""Native operators 7 and 9 against plain Python."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from lodestar.llm import host_rules, mixing

from . import cases

WORD = re.compile("[^\x20\x09-\x0d]+")


def rules(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed)


def test_document_rules_match_plain_python(spark):
    got = host_rules.document_rules(cases.table(spark)).select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert len(got) == len(cases.documents())
    for r in got:
        assert tuple(r)[2:] == rules(r["text"]), r["doc_id"]


def test_bad_host_loses_its_documents_and_clean_hosts_keep_theirs(spark):
    rows = [(i, cases.prose(i, 80), "en", f"good{i % 5}", 1) for i in range(100)]
    rows += [(1000 + i, "too short", "en", "bad", 1) for i in range(60)] + [(2000, cases.prose(9, 80), "en", "bad", 1)]
    got = {r["doc_id"]: r for r in host_rules.quality_rules(cases.table(spark, rows)).collect()}
    assert all(got[i]["kept"] for i in range(100))
    assert not got[2000]["base_failed"] and not got[2000]["kept"]


def test_beta_prior_is_bounded():
    assert host_rules.beta_prior(None, None) == (0.5, 0.5)
    a, b = host_rules.beta_prior(0.2, 0.0)
    assert a + b == pytest.approx(1e6)
    a, b = host_rules.beta_prior(0.5, 0.25)
    assert a + b == 1.0


def test_rules_on_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    empty = host_rules.quality_rules(cases.table(spark, []))
    assert empty.count() == 0
    odd = cases.table(spark).withColumns({"n_words": F.lit("x"), "kept": F.lit("y"), "host_rate": F.lit(1), "extra": F.lit(2)})
    out = host_rules.quality_rules(odd)
    assert out.columns.count("n_words") == 1 and "extra" in out.columns and dict(out.dtypes)["kept"] == "boolean"
    assert out.count() == len(cases.documents())


def expected_targets(sizes, share=1.5, cap=2):
    """Water filling in exact fractions: cap, reshare the excess, repeat."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = Fraction(share) * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: Fraction(cap * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def test_mix_targets_and_copies(spark):
    rows = cases.documents() + [(100 + i, cases.prose(i, 20 + i % 50), "en", f"s{i % 7}" if i % 3 else "hot", 1) for i in range(400)]
    out = mixing.mix_sources(cases.table(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in out:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    want = expected_targets(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]))
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= 2 * largest[s] + 0.1 * sizes[s]
    again = mixing.mix_sources(cases.table(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_repeated_rows_and_empty_table(spark):
    mixed = mixing.mix_sources(cases.table(spark))
    assert mixing.repeated(mixed).count() == sum(r["copies"] for r in mixed.collect())
    assert mixing.mix_sources(cases.table(spark, [])).count() == 0
    words_free = mixing.mix_sources(cases.table(spark, [(1, None, "en", "a", 0), (2, " ", "en", None, 0)])).collect()
    assert [(r["target"], r["taken"]) for r in words_free] == [(0.0, 0), (0.0, 0)]
    from pyspark.sql import functions as F

    clash = cases.table(spark).withColumns({"size": F.lit("x"), "target": F.lit("y"), "extra": F.lit(1)})
    out = mixing.mix_sources(clash)
    assert out.columns.count("size") == 1 and dict(out.dtypes)["size"] == "bigint" and "extra" in out.columns
    assert out.count() == len(cases.documents())


def test_stage_keeps_columns(spark):
    out = mixing.take_mix(spark, cases.table(spark), "")
    assert out.columns == cases.table(spark).columns

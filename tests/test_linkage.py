"""Record linkage: classifier rules against a plain-Python statement of
them, and blocked labels on the restaurant lists (regression counts)."""

import itertools

from pyspark.sql import functions as F

from lodestar.operators import linkage as LK
from lodestar.sources.tables import read_pairs_csv, read_records_csv
from goldens import restaurant_files

FIELDS = ("a", "b", "c")


def classify_brute(m_cnt, u_cnt, mu, lam):
    """Reference rules over exact counts: dict tuple -> label."""
    n_m, n_u = sum(m_cnt.values()), sum(u_cnt.values())
    seen = set(m_cnt) | set(u_cnt)

    def key(t):
        m, u = m_cnt.get(t, 0) / n_m, u_cnt.get(t, 0) / n_u
        return (0, -m, t) if u == 0 else (1, -(m / u), t)
    order = sorted(seen, key=key)
    out = {t: "possible match" for t in itertools.product(["low", "medium", "high"], repeat=3)}
    labelled = {}
    cum = 0
    for t in order:
        cum += u_cnt.get(t, 0)
        if cum <= mu * n_u + 1e-9:
            labelled[t] = "match"
        else:
            break
    cum = 0
    for t in reversed(order):
        cum += m_cnt.get(t, 0)
        if cum <= lam * n_m + 1e-9:
            labelled.setdefault(t, "unmatch")
        else:
            break
    out.update(labelled)
    return out


def test_classifier_matches_brute_force(spark):
    levels = ["low", "medium", "high"]
    m_cnt = {("high", "high", "high"): 30, ("high", "medium", "high"): 8, ("medium", "high", "low"): 5,
             ("low", "low", "low"): 2, ("high", "low", "medium"): 5}
    u_cnt = {("low", "low", "low"): 700, ("medium", "low", "low"): 150, ("high", "low", "medium"): 40,
             ("medium", "high", "low"): 10, ("low", "medium", "low"): 100}
    rows = [(*t, m_cnt.get(t, 0), u_cnt.get(t, 0)) for t in set(m_cnt) | set(u_cnt)]
    probs = spark.createDataFrame(rows, "s_a string, s_b string, s_c string, m_cnt long, u_cnt long")
    n_m, n_u = sum(m_cnt.values()), sum(u_cnt.values())
    probs = (probs.withColumn("n_m", F.lit(n_m)).withColumn("n_u", F.lit(n_u))
             .withColumn("m", F.col("m_cnt") / F.col("n_m")).withColumn("u", F.col("u_cnt") / F.col("n_u")))
    for mu, lam in [(0.0, 0.0), (0.01, 0.05), (0.06, 0.2), (0.2, 0.5), (1.0, 1.0)]:
        got = {(r.s_a, r.s_b, r.s_c): r.label for r in LK.classifier(probs, FIELDS, mu, lam).collect()}
        assert len(got) == 27 and set(levels) >= {x for t in got for x in t}
        assert got == classify_brute(m_cnt, u_cnt, mu, lam), (mu, lam)


def test_restaurants_blocked_on_city(spark):
    left, right, known_path, unmatched_path = restaurant_files()
    z = read_records_csv(spark, left)
    f = read_records_csv(spark, right)
    known = read_pairs_csv(spark, known_path)
    unmatched = read_pairs_csv(spark, unmatched_path)
    clf = LK.train_classifier(z, f, known, unmatched, 0.005, 0.005).cache()
    counts = {r.label: r.n_pairs for r in LK.label_counts(z, f, F.col("city"), F.col("city"), clf).collect()}
    assert counts == {"match": 75, "possible match": 6, "unmatch": 9379}
    pairs = LK.label_pairs(z, f, F.col("city"), F.col("city"), clf)
    by_label = {r.label: r["count"] for r in pairs.groupBy("label").count().collect()}
    assert by_label == counts
    # every pair shares the city, and each (zindex, findex) appears once
    assert pairs.count() == pairs.select("zindex", "findex").distinct().count() == 9460


def test_self_pair_weights(spark):
    recs = spark.createDataFrame([(1, "x", "b1"), (2, "x", "b1"), (3, "y", "b1"), (4, "x", "b2")],
                                 "index int, name string, blk string")
    clf = LK.tuple_domain(spark, ("name",)).withColumn("label", F.col("s_name"))
    counts = {r.label: r.n_pairs for r in LK.label_counts(recs, recs, F.col("blk"), F.col("blk"), clf,
                                                          ("name",), self_pairs_key="index").collect()}
    # block b1: ordered pairs of different records: (1,2),(2,1) equal names; 4 pairs x/y
    assert counts == {"high": 2, "low": 4}


def test_null_fields_keep_their_pairs(spark):
    """Three records, one without a name: all nine ordered pairs of the block
    get a label; a null pairs up at level low, also with a null."""
    recs = spark.createDataFrame([(1, "x", "b"), (2, None, "b"), (3, "x", "b"), (4, "x", None)], "index int, name string, blk string")
    clf = LK.tuple_domain(spark, ("name",)).withColumn("label", F.col("s_name"))
    counts = {r.label: r.n_pairs for r in LK.label_counts(recs, recs, F.col("blk"), F.col("blk"), clf, ("name",)).collect()}
    assert counts == {"high": 4, "low": 5}
    pairs = LK.label_pairs(recs, recs, F.col("blk"), F.col("blk"), clf, ("name",)).collect()
    assert {(r.zindex, r.findex): r.label for r in pairs} == {
        (a, b): "high" if {a, b} <= {1, 3} else "low" for a in (1, 2, 3) for b in (1, 2, 3)} and len(pairs) == 9


def test_training_counts_by_hand(spark):
    spark.catalog.clearCache()
    left = spark.createDataFrame([(1, "anna"), (2, "bob"), (3, None)], "index int, name string")
    known = spark.createDataFrame([(1, 1), (2, 2), (2, 2)], "zindex int, findex int")
    unmatched = spark.createDataFrame([(1, 2), (3, 1)], "zindex int, findex int")
    got = LK.training_distribution(left, left, known, unmatched, ("name",)).collect()
    assert {(r.s_name, r.m_cnt, r.u_cnt, r.n_m, r.n_u) for r in got} == {("high", 3, 0, 3, 2), ("low", 0, 2, 3, 2)}
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def expanded(groups):
    """The record pairs (zindex, findex, label) that rows of label_groups stand for."""
    own = {}
    for r in groups:
        if r.label == "member":
            own.setdefault(r.left_profile, []).append(r.zindex)
    out = []
    for r in groups:
        if r.label != "member":
            assert (r.zindex, r.findex) == (min(own[r.left_profile]), min(own[r.right_profile]))
            made = [(a, b, r.label) for a in own[r.left_profile] for b in own[r.right_profile] if a != b]
            assert len(made) == r.n_pairs > 0
            out += made
    assert all(r.findex == min(own[r.left_profile]) and r.n_pairs is None for r in groups if r.label == "member")
    return out


PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def groups_of(spark, sf_dir):
    from lodestar.plans import linkage_plans as LP
    return LK.label_groups(LP._records(spark, sf_dir), LP._block(), LP._classifier(spark, sf_dir), LP.FIELDS).collect()


def odd_parts(spark, path):
    """Repeated and null keys, keys of two profiles, null and empty fields."""
    import random
    rng = random.Random(5)
    rows = [(rng.choice([i, i, i, 7, None]), rng.choice(["blue ring", "blue rings", "old bolt", "", None]), rng.choice(["a", "b", "", None]),
             rng.choice(["SMALL", "SMALLER", None]), 1, 1.0) for i in range(70)]
    spark.createDataFrame(rows, PART).write.parquet(f"{path}/part.parquet")
    return rows


def test_groups_expand_to_all_pairs(spark, tmp_path):
    """The groups stand for exactly the pairs of label_pairs."""
    from lodestar.plans import linkage_plans as LP
    rows = odd_parts(spark, tmp_path)
    recs = LP._records(spark, str(tmp_path))
    every = LK.label_pairs(recs, recs, LP._block(), LP._block(), LP._classifier(spark, str(tmp_path)), LP.FIELDS)
    expected = sorted((r.zindex, r.findex, r.label) for r in every.where("zindex != findex").collect())
    assert len(expected) == sum(a[0] is not None and b[0] is not None and a[0] != b[0] and a[2] == b[2] is not None for a in rows for b in rows)
    assert sorted(expanded(groups_of(spark, str(tmp_path)))) == expected


def copies(spark, path):
    """Three hundred copies of two parts."""
    spark.createDataFrame([(i, ("blue ring", "old bolt")[i % 2], "a", "SMALL", 1, 1.0) for i in range(300)], PART).write.parquet(f"{path}/part.parquet")


def test_groups_do_not_grow_with_the_square_of_copies(spark, tmp_path):
    """Four pairs of profiles and their members, for all 89,700 pairs."""
    copies(spark, tmp_path)
    groups = groups_of(spark, str(tmp_path))
    assert len(groups) == 4 + 300
    assert {(a, b) for a, b, _ in expanded(groups)} == set(itertools.permutations(range(300), 2))


def test_link_pairs_are_record_pairs(spark, tmp_path):
    """Copies too: a row with its label for each of the 89,700 pairs."""
    from lodestar.plans import linkage_plans as LP
    copies(spark, tmp_path)
    pairs = LP.link_pairs(spark, str(tmp_path))
    assert pairs.columns == ["zindex", "findex", "label"]
    rows = pairs.collect()
    assert len(rows) == 89_700 and {(r.zindex, r.findex) for r in rows} == set(itertools.permutations(range(300), 2))
    labels = {(r.s_name, r.s_brand, r.s_type): r.label for r in LP.link_classifier(spark, str(tmp_path)).collect()}
    assert all(r.label == labels["high" if (r.zindex - r.findex) % 2 == 0 else "low", "high", "high"] for r in rows)


def test_link_pairs_of_odd_rows_as_in_sql(spark, tmp_path):
    import duckdb

    from lodestar.plans import linkage_plans as LP
    rows = odd_parts(spark, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    expected = sorted(con.execute(LP.ORACLE["link_pairs"]).fetchall())
    assert len(expected) == sum(a[0] is not None and b[0] is not None and a[0] != b[0] and a[2] == b[2] is not None for a in rows for b in rows)
    assert sorted(map(tuple, LP.link_pairs(spark, str(tmp_path)).collect())) == expected


def test_io_pair_labels_are_record_pairs(spark, tmp_path):
    """The written lines are read back as the rows of link_pairs, as the SQL has them."""
    import duckdb

    from lodestar.plans import io_plans as IO
    odd_parts(spark, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    pairs = IO.io_pair_labels(spark, str(tmp_path))
    assert pairs.columns == ["zindex", "findex", "label"]
    assert sorted(map(tuple, pairs.collect())) == sorted(con.execute(IO.ORACLE["io_pair_labels"]).fetchall())


def test_records_are_not_broadcast(spark, sf_small):
    """However small the files of a table look: its rows are joined by key
    without passing through the driver."""
    import re

    from lodestar.plans import linkage_plans as LP
    plan = LP.link_pairs(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    by_key = re.findall(r"(\w+Join) \[[^\]]*(?:index|partkey)#", plan)
    assert len(by_key) >= 4 and set(by_key) == {"SortMergeJoin"}
    by_profile = re.findall(r"(\w+Join) \[block#\d+, (?:left|right)_profile#", plan)
    assert len(by_profile) == 2 and set(by_profile) == {"SortMergeJoin"}


def test_links_cover_every_pair_of_a_brand(spark, sf_small):
    """Pairs of one brand that differ in type or size are labelled too."""
    from lodestar.plans import linkage_plans as LP
    from lodestar.sources.tables import load

    brands = {}
    for r in load(spark, sf_small, "part").select("p_partkey", "p_brand").collect():
        brands.setdefault(r.p_brand, []).append(r.p_partkey)
    expected = {p for keys in brands.values() for p in itertools.permutations(keys, 2)}
    rows = LP.link_pairs(spark, sf_small).collect()
    assert len(rows) == len(expected) and {(r.zindex, r.findex) for r in rows} == expected
    counts = {r.label: r.n_pairs for r in LP.link_label_counts(spark, sf_small).collect()}
    assert counts == {x: sum(r.label == x for r in rows) for x in {r.label for r in rows}}


def test_signatures_bound_the_score(spark):
    """No pair of random values scores above its signatures' bound, and most
    pairs that are low are left out by it."""
    import random

    from lodestar.functions.similarity import highest_score, signature, with_jaro_winkler
    rng = random.Random(4)
    values = ["", "a", "aaaa", "日本 語", "x" * 40, "ünï"] + ["".join(rng.choice("abcdefgh éß") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    pairs = spark.createDataFrame([(a, b) for a in values for b in values], "a string, b string")
    rows = with_jaro_winkler(pairs, "a", "b", "jw").select(
        "jw", highest_score(signature(F.col("a")), signature(F.col("b"))).alias("most")).collect()
    assert all(r.jw <= r.most + 1e-12 for r in rows)
    assert sum(r.most >= 0.8 for r in rows) < len(rows) / 2


def test_classes_and_members_stand_for_all_pairs(spark):
    """Repeated records, null and empty fields, a null block, several near fields: classes and members expand to label_pairs,
    and tuple counts equal those of all pairs."""
    import random
    rng = random.Random(2)
    names = ["martha", "marhta", "marta", "dixon", "dickson", "", None]
    rows = [(i, rng.choice(names), rng.choice(["oak street", "oak stret", "elm", None]), rng.choice(["x", "y", None])) for i in range(60)]
    recs = spark.createDataFrame(rows, "index int, name string, addr string, blk string")
    clf = LK.tuple_domain(spark, ("name", "addr")).withColumn("label", F.concat_ws("/", "s_name", "s_addr"))
    block, fields = F.col("blk"), ("name", "addr")
    pairs = {(r.zindex, r.findex): r.label for r in LK.label_pairs(recs, recs, block, block, clf, fields).collect()}
    assert set(pairs) == {(a[0], b[0]) for a in rows for b in rows if a[3] is not None and a[3] == b[3]}
    different = {p: x for p, x in pairs.items() if p[0] != p[1]}
    of = {r["index"]: (r.block, r.profile) for r in LK.members(recs, block, fields).collect()}
    classes = {(r.block, r.left_profile, r.right_profile): (r.label, r.n_pairs)
               for r in LK.label_classes(recs, recs, block, block, clf, fields, self_pairs=True).collect()}
    expected = {}
    for (a, b), label in different.items():
        at = (of[a][0], of[a][1], of[b][1])
        expected[at] = (label, expected.get(at, (label, 0))[1] + 1)
    assert classes == expected
    for self_pairs, every in ((None, pairs), ("index", different)):
        counts = {r.label: r.n_pairs for r in LK.label_counts(recs, recs, block, block, clf, fields, self_pairs).collect()}
        assert counts == {x: sum(y == x for y in every.values()) for x in set(every.values())}


def test_signature_share(spark, sf_small):
    from lodestar.plans import linkage_plans as LP
    recs = LP._records(spark, sf_small)
    got = {r.field: (r.n_pairs, r.n_scored) for r in LK.signature_share(recs, recs, F.col("brand"), F.col("brand"), LP.FIELDS).collect()}
    low = {f: n - LP.near_value_pairs(spark, sf_small).where(F.col("field") == f).count() for f, (n, _) in got.items()}
    assert set(got) == set(LP.FIELDS) and all(0 < s <= n for n, s in got.values()) and low["name"] > 0
    assert got["name"][1] < got["name"][0]
    print(got)

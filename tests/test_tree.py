"""Decision tree: the five golden prediction lists and the feature
preparation golden (raw -> binned rows equal training + testing)."""

from collections import Counter

import pytest

from lodestar.operators import prep as P
from lodestar.operators import tree as TR
from lodestar.sources.tables import read_string_table
from goldens import diabetes_files, tree_config, tree_configs

CONFIGS = sorted(c[0] for c in tree_configs()) or ["missing"]


@pytest.mark.parametrize("config", CONFIGS)
def test_golden_predictions(spark, config):
    _, train_path, test_path, expected = tree_config(config)
    train = read_string_table(spark, train_path)
    test = read_string_table(spark, test_path)
    model = TR.fit(train)
    got = [r.prediction for r in TR.predict(model, test).orderBy("row_id").collect()]
    assert got == expected
    assert all(isinstance(x, str) for x in got)


def test_all_golden_configurations_found():
    if not tree_configs():
        pytest.skip("reference data not present")
    assert len(tree_configs()) == 5


FRUIT = [("red", "small", "cherry"), ("red", "small", "cherry"), ("red", "big", "apple"), ("green", "big", "apple"),
         ("green", "big", "melon"), ("green", "small", "grape"), ("yellow", "big", "melon"), ("yellow", None, "lemon"),
         (None, "big", "apple"), ("red", "small", None)]


def _fruit(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(FRUIT)], "row_id int, colour string, size string, kind string")


def test_own_tree_is_as_worked_out_by_hand(spark):
    model = TR.fit(_fruit(spark))
    nodes = {r.node_id: r for r in model.nodes.collect()}
    root = nodes[TR.ROOT]
    # class counts: apple 3, cherry 2, melon 2, grape 1, lemon 1; size (gain ratio 0.2447..) beats colour
    assert (root.n, root.label, root.split_attr) == (9, "apple", "size")
    kids = {r.value: r for r in nodes.values() if r.parent_id == TR.ROOT}
    assert {v: (r.n, r.label, r.split_attr) for v, r in kids.items()} == {"big": (5, "apple", "colour"), "small": (3, "cherry", "colour")}
    assert len(nodes) == 1 + 2 + 3 + 2 and all(len(i) == 32 for i in nodes)
    listing = {r.node_id: r for r in TR.describe(model).collect()}
    assert [(c.value, c.child_label) for c in listing[TR.ROOT].children] == [("big", "apple"), ("small", "cherry")]


def test_scoring_stops_at_unseen_and_null_values(spark):
    model = TR.fit(_fruit(spark))
    rows = [(1, "red", "small"), (2, "green", "big"), (3, "blue", "big"), (4, "yellow", None), (5, None, None), (5, None, None)]
    got = TR.predict(model, spark.createDataFrame(rows, "row_id int, colour string, size string")).collect()
    assert sorted((r.row_id, r.prediction) for r in got) == [
        (1, "cherry"), (2, "apple"), (3, "apple"), (4, "apple"), (5, "apple"), (5, "apple")]


def test_tree_of_one_class_and_of_nothing(spark):
    one = TR.fit(_fruit(spark).where("kind = 'apple'"))
    assert [(r.label, r.split_attr) for r in one.nodes.collect()] == [("apple", None)]
    none = TR.fit(_fruit(spark).where("false"))
    assert none.nodes.count() == 0


def test_split_rules_on_tennis(spark):
    _, train_path, _, _ = tree_config("tennis")
    model = TR.fit(read_string_table(spark, train_path))
    root = model.nodes.where("depth = 0").first()
    # Gini gain ratio at the root: Humidity 0.0918 beats Outlook 0.0738
    assert root.split_attr == "Humidity" and root.label == "Yes" and abs(root.gain_ratio - 0.091836734694) < 1e-9
    # one attribute at most once per path
    parents = {r.node_id: r for r in model.nodes.collect()}
    for r in model.nodes.where("split_attr IS NOT NULL").collect():
        above, used = r, []
        while above.parent_id is not None:
            above = parents[above.parent_id]
            used.append(above.split_attr)
        assert r.split_attr not in used
    listing = TR.describe(model).where("depth = 0").first()
    assert sorted(c.value for c in listing.children) == ["High", "Normal"]


def test_diabetes_preparation_golden(spark):
    """Raw rows, cleaned and binned, equal the shipped training + testing rows
    as a multiset; both shipped splits hold the same rows, so all binned
    tables together hold each prepared row twice."""
    raw_path, binned_paths = diabetes_files()
    raw = spark.read.option("header", "true").option("inferSchema", "false").csv(raw_path)
    prepared = P.pima_prepare(raw)
    binned = [spark.read.option("header", "true").csv(p) for p in binned_paths]
    assert all(prepared.columns == b.columns for b in binned)
    got = Counter(tuple(r) for r in prepared.collect())
    expected = Counter(tuple(r) for b in binned for r in b.collect())
    assert len(binned) == 4
    assert expected == Counter({k: 2 * v for k, v in got.items()})

"""Driver contract: entry runs, every oracle has a query, and the oracle
SQL agrees with Spark on the smallest scale factor for a fast subset."""

import duckdb
import pytest

import __spark_entry__ as E
from lodestar.sources.tables import TABLE_SCHEMAS, table_path
from scripts.oracle_check import digest

FAST = ["search_tier1", "search_tier2", "search_tier3", "terms_all", "page_index", "sequence_groups",
        "table_diff", "tree_split_stats", "prep_bins", "link_classifier", "links_follow", "crawl_links", "link_pairs", "link_label_counts",
        "link_classes", "link_members", "near_value_pairs", "io_pair_labels", "io_code_object", "bitmap_terms_all", "bitmap_terms_any",
        "table_diff_checksums"]


def test_entry_runs(spark, sf_small):
    df = E.entry(spark)
    assert df.columns == ["dept", "course_num", "title", "section_num", "day", "time_start", "time_end",
                          "enrollment", "building_code", "walking_time"]
    assert df.count() >= 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLE_SCHEMAS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_small, t)}')")
    df = E.queries()[name](spark, sf_small)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert digest(df.columns, got) == digest(cols, exp)

"""File sources and sinks as round trips: a table is written in the format,
read back by the source, and the read rows are the result. The files lie in the
shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import STOP_WORDS
from lodestar.operators import index as X
from lodestar.operators import search as S
from lodestar.plans import index_plans, linkage_plans, search_plans
from lodestar.session import new_path
from lodestar.sources import sinks
from lodestar.sources import tables as SRC
from lodestar.sources.tables import load


def io_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id index as ``id|word`` lines, read back."""
    path = new_path(spark, "index")
    sinks.write_index(index_plans.index_ids(spark, sf_dir), path)
    return spark.read.schema("id bigint, word string").option("sep", "|").csv(path)


def io_pair_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs as lines, read back."""
    path = new_path(spark, "pairs")
    sinks.write_pair_labels(linkage_plans.link_pairs(spark, sf_dir), path)
    return spark.read.schema("zindex bigint, findex bigint, label string").csv(path)


def io_distinct_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S6: the distinct part types, one per line, read back."""
    path = new_path(spark, "list")
    sinks.write_distinct_list(load(spark, sf_dir, "part"), "p_type", path)
    return SRC.read_single_column(spark, path, "p_type")


def io_code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + X6: a code map as JSON lines (splittable), read back, inverted."""
    path = new_path(spark, "codes")
    part = load(spark, sf_dir, "part")
    codes = part.select(F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("code"),
                        F.col("p_partkey").cast("int").alias("id"))
    codes.write.json(path)
    return SRC.invert_code_map(SRC.read_code_map_lines(spark, path))


CODES_A_FILE = 500


def io_code_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single JSON objects with commas, quotes, backslashes and braces in
    the codes, one to a file, each read by as many tasks as it has splits."""
    path = new_path(spark, "code-objects")
    k = F.col("p_partkey")
    code = F.concat(F.lit('{"'), F.col("p_name"), F.lit(', \\'), k.cast("string"), F.lit('}, "'))
    entry = F.struct(code.alias("key"), k.cast("int").alias("value"))
    (load(spark, sf_dir, "part").groupBy((k / CODES_A_FILE).cast("long").alias("file"))
     .agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))  # at most CODES_A_FILE codes
     .write.partitionBy("file").text(path))
    return SRC.read_code_map_split(spark, path)


def io_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a record list with a header, read back under its own names."""
    path = new_path(spark, "records")
    c = load(spark, sf_dir, "supplier")
    c.select(F.col("s_suppkey").cast("int").alias("index"), F.col("s_name").alias("restaurant name"),
             F.concat(F.lit("city, "), F.col("s_nationkey").cast("string")).alias("city"),
             F.concat(F.lit('no "'), F.col("s_suppkey").cast("string"), F.lit('"')).alias("street address")
             ).write.option("header", "true").option("escape", '"').csv(path)
    return SRC.read_records_csv(spark, path)


def io_string_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read back with every column as text."""
    path = new_path(spark, "strings")
    load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").write.option("header", "true").csv(path)
    return SRC.read_string_table(spark, path).drop("row_id")


def search_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: a search result under its display labels."""
    return S.with_display_names(search_plans.QUERIES["search_tier2_only"](spark, sf_dir))


def search_result_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 as a table: the number of rows of a search."""
    return search_plans.QUERIES["search_tier2_only"](spark, sf_dir).agg(F.count(F.lit(1)).alias("n_results"))


PAGE_PARTS, SEQUENCE = 10, 5


def _catalogue(spark, sf_dir):
    """Catalogue pages made from the parts: ten blocks a page, every fifth one
    heads a sequence, with attributes, inner elements and entities around."""
    part = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    kind = F.when(k % SEQUENCE == 0, "main").otherwise("subsequence")
    block = F.concat(
        F.lit('<div id="b" class="courseblock '), kind, F.lit('"><p class="courseblocktitle"><b>'),
        F.lpad(k.cast("string"), 10, "0"), F.lit(" "), F.col("p_name"), F.lit("</b></p><div>no &amp; text</div>"),
        F.lit('<p lang="en" class="courseblockdesc">'), F.col("p_type"), F.lit(".</p></div>\n"))
    return (part.select((k / PAGE_PARTS).cast("long").alias("page_id"), F.struct(k.alias("k"), block.alias("b")).alias("x"))
            .groupBy("page_id").agg(F.array_sort(F.collect_list("x")).alias("x"))  # ten parts a page
            .select("page_id", F.concat(F.lit("<html><body><div>"), F.array_join("x.b", ""), F.lit("</div></body></html>")).alias("html")))


def course_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5, T6, T7, T8, W5, G6 from html: words of every course block, members
    of a sequence with their header's words."""
    return X.course_postings(X.course_blocks(_catalogue(spark, sf_dir)))




QUERIES = {
    "io_index": io_index,
    "io_pair_labels": io_pair_labels,
    "io_distinct_list": io_distinct_list,
    "io_code_map": io_code_map,
    "io_code_object": io_code_object,
    "io_records": io_records,
    "io_string_table": io_string_table,
    "search_display": search_display,
    "search_result_count": search_result_count,
    "course_words": course_words,
}

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

ORACLE = {
    "io_index": index_plans.ORACLE["index_ids"],
    "io_pair_labels": linkage_plans.ORACLE["link_pairs"],
    "io_distinct_list": "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL",
    "io_code_map": "SELECT CAST(p_partkey AS INTEGER) AS id, 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS code FROM part",
    "io_code_object": """SELECT '{"' || p_name || ', \\' || CAST(p_partkey AS VARCHAR) || '}, "' AS code, CAST(p_partkey AS INTEGER) AS id FROM part""",
    "io_records": """SELECT CAST(s_suppkey AS INTEGER) AS index, s_name AS name, 'city, ' || CAST(s_nationkey AS VARCHAR) AS city,
  'no "' || CAST(s_suppkey AS VARCHAR) || '"' AS address FROM supplier""",
    "io_string_table": """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""",
    "search_display": """SELECT dept AS "Department", course_num AS "Course", title AS "Title", section_num AS "Section", day AS "Day",
  time_start AS "Time (start)", time_end AS "Time (end)", enrollment AS "Enrollment" FROM (""" + search_plans.ORACLE["search_tier2_only"] + ")",
    "search_result_count": "SELECT count(*) AS n_results FROM (" + search_plans.ORACLE["search_tier2_only"] + ")",
    "course_words": f"""
WITH b AS (SELECT p_partkey // {PAGE_PARTS} AS page_id, p_partkey AS k, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS code,
           p_partkey - p_partkey % {SEQUENCE} AS head, lower(p_name || ' ' || p_type) AS t FROM part),
w AS (SELECT page_id, k, code, head, unnest(string_split(t, ' ')) AS word FROM b)
SELECT DISTINCT page_id, code, word FROM (
  SELECT page_id, code, word FROM w
  UNION ALL
  SELECT m.page_id, m.code, h.word FROM b AS m JOIN w AS h ON h.k = m.head AND h.page_id = m.page_id WHERE m.k <> m.head)
WHERE word <> '' AND word NOT IN ({_STOP})""",
}

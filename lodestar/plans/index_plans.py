"""Index and term-search queries (jobs B and C) over documents, pages and
conversations. Whole texts are processed; nothing is truncated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.text import STOP_WORDS, WS_SPLIT_RE2
from lodestar.operators import bitmaps as B
from lodestar.operators import index as X
from lodestar.operators.search import all_terms_ids, any_term_ids
from lodestar.sources.tables import fetchable_pages, load

TERMS_ALL = ("en", "was", "tion")
TERMS_ANY = ("tion", "ing")
# Fixed value of this binding: pages of this host family have ids in the code map.
MAPPED_HOST_RE = r"^https?://[^/?#]*\.example\.com([/?#]|$)"


def doc_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (doc_id, word) over every document."""
    return X.text_postings(load(spark, sf_dir, "documents"), ["doc_id"], ["text"], unique=True)


def word_doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word, the number of documents containing it."""
    return X.word_frequency(doc_postings(spark, sf_dir), "doc_id").withColumnRenamed("n_keys", "n_docs")


def terms_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + J5: documents containing every term."""
    docs = load(spark, sf_dir, "documents")
    hits = X.matching_postings(docs, "doc_id", "text", TERMS_ALL)
    return all_terms_ids(hits, TERMS_ALL, key="doc_id")


def terms_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents containing at least one term (semi join, no duplicates)."""
    docs = load(spark, sf_dir, "documents")
    hits = X.matching_postings(docs, "doc_id", "text", TERMS_ANY)
    return docs.select("doc_id").join(any_term_ids(hits, TERMS_ANY, key="doc_id"), "doc_id", "left_semi")


def _term_bitmaps(spark, sf_dir, terms):
    hits = X.matching_postings(load(spark, sf_dir, "documents"), "doc_id", "text", terms)
    return B.word_bitmaps(hits, "doc_id")


def bitmap_terms_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + J5 by bitmaps: documents with every term."""
    return B.bitmap_ids(B.all_terms_bitmap(_term_bitmaps(spark, sf_dir, TERMS_ALL), TERMS_ALL), "doc_id")


def bitmap_terms_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 by bitmaps: documents with at least one term."""
    return B.bitmap_ids(B.any_term_bitmap(_term_bitmaps(spark, sf_dir, TERMS_ANY), TERMS_ANY), "doc_id")


def _page_postings(spark, sf_dir):
    blocks = X.page_blocks(fetchable_pages(load(spark, sf_dir, "pages")))
    return X.text_postings(blocks, ["page_id", "code"], ["title_text", "desc_text"])


def page_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (page_id, code, word) from each page's
    article block (title words after the key + description words)."""
    return _page_postings(spark, sf_dir)


def _code_map(spark, sf_dir):
    pages = fetchable_pages(load(spark, sf_dir, "pages")).where(F.col("url").rlike(MAPPED_HOST_RE))
    blocks = X.page_blocks(pages)
    return blocks.groupBy("code").agg(F.min("page_id").alias("id"))


def index_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings keyed by code mapped to ids through a code map derived
    from the pages of one host family; output distinct (id, word)."""
    postings = _page_postings(spark, sf_dir).select("code", "word")
    return X.map_codes(postings, _code_map(spark, sf_dir))


def index_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 report: codes that have postings but no id."""
    postings = _page_postings(spark, sf_dir).select("code", "word")
    return X.unmapped_codes(postings, _code_map(spark, sf_dir))


def index_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G14 + X4 over the id index."""
    return X.index_quality(index_ids(spark, sf_dir), "id")


def index_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 + X6: for every id of the code map, 'tion' should appear and the
    ignored word 'the' should not."""
    ids = _code_map(spark, sf_dir).select("id")
    expected = (ids.select("id", F.lit("tion").alias("word"), F.lit(True).alias("should_appear"))
                .unionByName(ids.select("id", F.lit("the").alias("word"), F.lit(False).alias("should_appear"))))
    return X.check_expected(index_ids(spark, sf_dir), expected, "id")


def sequence_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn belongs to the last 'user' turn at or
    before it (null before the first one)."""
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return X.last_marker(conv, "conv_id", "turn", F.col("role") == "user", out="header_turn")


def sequence_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn's words plus the words of its header turn."""
    conv = load(spark, sf_dir, "conversations")
    groups = X.last_marker(conv.select("conv_id", "turn", "role"), "conv_id", "turn",
                           F.col("role") == "user", out="header_turn")
    postings = X.text_postings(conv, ["conv_id", "turn"], ["text"], unique=True)
    return X.inherited_postings(groups, "conv_id", "turn", "header_turn", postings)


QUERIES = {
    "doc_postings": doc_postings,
    "word_doc_freq": word_doc_freq,
    "terms_all": terms_all,
    "terms_any": terms_any,
    "bitmap_terms_all": bitmap_terms_all,
    "bitmap_terms_any": bitmap_terms_any,
    "page_index": page_index,
    "index_ids": index_ids,
    "index_unmapped": index_unmapped,
    "index_quality": index_quality,
    "index_expected": index_expected,
    "sequence_groups": sequence_groups,
    "sequence_words": sequence_words,
}

# ---------------------------------------------------------------------------
# DuckDB oracles

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WS = WS_SPLIT_RE2
_WS_CLASS = _WS[:-1]


def _words(key_sql: str, text_sql: str, source: str) -> str:
    """Distinct (keys, word) of one text expression, as SQL."""
    return f"""SELECT DISTINCT {key_sql}, w AS word FROM (
  SELECT {key_sql}, regexp_replace(unnest(string_split_regex(lower({text_sql}), '{_WS}')), '[!.:]$', '') AS w
  FROM {source}) WHERE length(w) > 0 AND w NOT IN ({_STOP})"""


_MARKUP = ("regexp_replace(html, '(?is)<!--.*?(?:-->|$)|<script\\b[^>]*>.*?(?:</script\\s*>|$)"
           "|<style\\b[^>]*>.*?(?:</style\\s*>|$)', ' ', 'g')")


def _html_text(x: str) -> str:
    out = f"regexp_replace({x}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    out = f"regexp_replace({out}, '(?s)<!--.*?-->', ' ', 'g')"
    out = f"regexp_replace({out}, '<[^>]*>', ' ', 'g')"
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = f"replace({out}, '{ent}', '{ch}')"
    return out


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS_CLASS}+|{_WS_CLASS}+$', '', 'g')"


_BLOCKS = f"""
b0 AS (SELECT page_id, url, unnest(regexp_extract_all({_MARKUP}, '(?is)<article(?:\\s[^>]*)?>(.*?)</article>', 1)) AS block
       FROM pages WHERE html IS NOT NULL AND length(html) > 0),
b1 AS (SELECT page_id, url,
         {_html_text("regexp_extract(block, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)")} AS title,
         {_html_text("regexp_replace(block, '(?is)<h1(?:\\s[^>]*)?>.*?</h1>', ' ', 'g')")} AS desc_text
       FROM b0 WHERE length(block) > 0),
blocks AS (SELECT page_id, url, translate(substring({_trim('title')}, 1, 10), chr(160), ' ') AS code,
         substring({_trim('title')}, 11) AS title_text, desc_text FROM b1),
page_words AS (
  {_words('page_id, code', "coalesce(title_text, '')", 'blocks')}
  UNION
  {_words('page_id, code', "coalesce(desc_text, '')", 'blocks')}),
code_map AS (SELECT code, min(page_id) AS id FROM blocks
  WHERE regexp_matches(url, '{MAPPED_HOST_RE}') GROUP BY code),
id_index AS (SELECT DISTINCT m.id, p.word FROM page_words p JOIN code_map m ON p.code = m.code)
"""

_GROUPS = """
groups AS (SELECT conv_id, turn, role,
  max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header_turn
  FROM conversations)
"""

ORACLE = {
    "doc_postings": _words("doc_id", "text", "documents"),
    "word_doc_freq": f"""SELECT word, count(doc_id) AS n_docs FROM ({_words("doc_id", "text", "documents")}) GROUP BY word""",
    "terms_all": f"""SELECT doc_id FROM ({_words("doc_id", "text", "documents")})
WHERE word IN ('en', 'tion', 'was') GROUP BY doc_id HAVING count(DISTINCT word) = 3""",
    "terms_any": f"""SELECT doc_id FROM documents WHERE doc_id IN (
  SELECT doc_id FROM ({_words("doc_id", "text", "documents")}) WHERE word IN ('ing', 'tion'))""",
    "page_index": "WITH " + _BLOCKS + "SELECT page_id, code, word FROM page_words",
    "index_ids": "WITH " + _BLOCKS + "SELECT id, word FROM id_index",
    "index_unmapped": "WITH " + _BLOCKS + """SELECT DISTINCT code FROM page_words
WHERE code NOT IN (SELECT code FROM code_map)""",
    "index_quality": "WITH " + _BLOCKS + f"""SELECT id, count(word) AS n_rows, count(DISTINCT word) AS n_words,
  count(*) FILTER (WHERE word IN ({_STOP})) AS n_ignored,
  count(word) - count(DISTINCT word) AS n_duplicates
FROM id_index GROUP BY id""",
    "index_expected": "WITH " + _BLOCKS + """, expected AS (
  SELECT id, 'tion' AS word, true AS should_appear FROM code_map
  UNION ALL SELECT id, 'the' AS word, false AS should_appear FROM code_map)
SELECT e.id, e.word, e.should_appear, (i.id IS NOT NULL) AS found,
       ((i.id IS NOT NULL) = e.should_appear) AS passed
FROM expected e LEFT JOIN id_index i ON e.id = i.id AND e.word = i.word""",
    "sequence_groups": "WITH " + _GROUPS + "SELECT conv_id, turn, role, header_turn FROM groups",
    "sequence_words": "WITH " + _GROUPS + f""", p AS ({_words("conv_id, turn", "text", "conversations")})
SELECT conv_id, turn, word FROM p
UNION
SELECT g.conv_id, g.turn, p.word FROM groups g JOIN p ON p.conv_id = g.conv_id AND p.turn = g.header_turn
WHERE g.header_turn IS NOT NULL AND g.turn <> g.header_turn""",
}
ORACLE |= {"bitmap_terms_all": ORACLE["terms_all"], "bitmap_terms_any": ORACLE["terms_any"]}

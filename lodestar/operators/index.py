"""Word index building (job B): block extraction from html (T5), key from a
title (T6), tokenising (T7), stop words (F14), postings (G6, G7), code to id
mapping (J11), sequence grouping (W5) with inherited words (T8), and the
index checks (G14, X5).

The index is kept as flat postings ``(key, word)``: one row per distinct
pair. The grouped ``word -> array<key>`` view splits a very common word
over several bounded rows instead of collecting it into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.text import (STOP_WORDS, html_element, html_elements, html_text, index_words, markup,
                                     tag_tokens, title_key, title_rest)


# --- T5 / T6: blocks of a page ------------------------------------------------

def page_blocks(pages: DataFrame, block_tag: str = "article", title_tag: str = "h1",
                key_width: int = 10) -> DataFrame:
    """Every ``block_tag`` element of every page, one row each; its
    ``title_tag`` text is the title, the rest of the block is the description.
    The key is the first ``key_width`` characters of the trimmed title (T6),
    the title words are what follows the key. Comments, scripts and styles
    open and close no element.

    Output: page_id, block_no (from 0), code, title_text, desc_text."""
    blocks = pages.select("page_id", F.posexplode(html_elements(markup(F.col("html")), block_tag)).alias("block_no", "block"))
    title_html = html_element(F.col("block"), title_tag)
    desc_html = F.regexp_replace("block", rf"(?is)<{title_tag}(?:\s[^>]*)?>.*?</{title_tag}\s*>", " ")
    return (blocks.where(F.length("block") > 0)
            .select("page_id", "block_no", html_text(title_html).alias("title"), html_text(desc_html).alias("desc_text"))
            .select("page_id", "block_no", title_key(F.col("title"), key_width).alias("code"),
                    title_rest(F.col("title"), key_width).alias("title_text"), "desc_text"))


# --- G6 / G7: postings ------------------------------------------------------------

def text_postings(df: DataFrame, key_cols, text_cols, stop_words=STOP_WORDS, unique: bool = False) -> DataFrame:
    """G6 + G7: distinct (key..., word) over the words of every text column.

    Words of all text columns are concatenated per row before one explode;
    ``distinct`` is the union over blocks and pages (a word found twice for
    one key is one posting). With ``unique`` the caller states that a key has
    one row: its words are distinct already and nothing is shuffled."""
    words = F.array_distinct(F.concat(*[index_words(F.coalesce(F.col(c), F.lit("")), stop_words, distinct=True)
                                        for c in text_cols]))
    out = df.select(*key_cols, F.explode(words).alias("word"))
    return out if unique else out.distinct()


def matching_postings(df: DataFrame, key: str, text_col: str, terms) -> DataFrame:
    """Postings restricted to given terms: the words are filtered inside the
    array before the explode, so the non-matching words of a long text never
    become rows."""
    terms = sorted(set(terms))
    wanted = F.array(*[F.lit(t) for t in terms])
    # exact pre-filter: a text without a term as a substring cannot hold it as a word
    lowered = F.lower(F.col(text_col))
    any_sub = F.lit(False)
    for t in terms:
        any_sub = any_sub | (F.instr(lowered, t) > 0)
    words = F.array_intersect(index_words(F.col(text_col), distinct=True), wanted)
    return (df.where(any_sub).select(key, F.explode(words).alias("word")).distinct())


def grouped_index(postings: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """The dict form word -> sorted keys: every word has up to ``parts`` rows
    (``part``, by hash of the key, whatever the size), so a very common word
    is not collected into one task. Rows of one word together hold exactly its
    key set."""
    return (postings.withColumn("part", F.pmod(F.xxhash64(F.col(key)), F.lit(parts)))
            .groupBy("word", "part").agg(F.array_sort(F.collect_set(key)).alias("keys")))


def word_frequency(postings: DataFrame, key: str) -> DataFrame:
    """Per word, the number of keys it appears for (partial counts map-side)."""
    return postings.groupBy("word").agg(F.count(key).alias("n_keys"))


# --- J11: code -> id ---------------------------------------------------------------

def map_codes(postings: DataFrame, code_map: DataFrame) -> DataFrame:
    """(code, word) + (code, id) -> distinct (id, word)."""
    return postings.join(code_map, "code").select("id", "word").distinct()


def unmapped_codes(postings: DataFrame, code_map: DataFrame) -> DataFrame:
    """Codes with postings but no id (the reference would raise on them)."""
    return postings.select("code").distinct().join(code_map, "code", "left_anti")


# --- G14 / X4 / X5: index checks ---------------------------------------------------------

def index_quality(index: DataFrame, key: str = "id", stop_words=STOP_WORDS) -> DataFrame:
    """G14 + X4: per key, rows, distinct words, duplicate rows and ignored
    words present (both must be 0 for a good index)."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    return (index.groupBy(key)
            .agg(F.count("word").alias("n_rows"), F.countDistinct("word").alias("n_words"),
                 F.count_if(F.array_contains(stop, F.col("word"))).alias("n_ignored"))
            .withColumn("n_duplicates", F.col("n_rows") - F.col("n_words")))


def check_expected(index: DataFrame, expected: DataFrame, key: str = "id") -> DataFrame:
    """Expected (key, word, should_appear) left-joined to the index;
    ``passed`` says whether presence equals expectation."""
    present = index.select(key, "word").distinct().withColumn("found", F.lit(True))
    return (expected.join(present, [key, "word"], "left")
            .withColumn("found", F.coalesce(F.col("found"), F.lit(False)))
            .withColumn("passed", F.col("found") == F.col("should_appear")))


# --- W5: sequence grouping -------------------------------------------------------------------

def last_marker(df: DataFrame, part: str, order: str, is_marker: Column,
                out: str = "group_key", chunk: int = 4096) -> DataFrame:
    """For each row, the ``order`` value of the last marker row at or
    before it in its ``part`` (null when there is none).

    A segmented scan in two levels so one huge part never sorts in one task:
    rows are windowed inside (part, order div chunk) only; the marker carried
    in from earlier chunks comes from a table with one row per chunk, whose
    window is ``chunk`` times smaller. Requires an integral ``order``."""
    c = F.expr(f"`{order}` div {chunk}")
    rows = df.withColumn("_chunk", c).withColumn("_mark", F.when(is_marker, F.col(order)))
    w_in = (Window.partitionBy(part, "_chunk").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_within", F.max("_mark").over(w_in))
    chunks = rows.groupBy(part, "_chunk").agg(F.max("_mark").alias("_cmax"))
    w_prev = (Window.partitionBy(part).orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.withColumn("_carry", F.max("_cmax").over(w_prev)).select(part, "_chunk", "_carry")
    return (rows.join(chunks, [part, "_chunk"])
            .withColumn(out, F.coalesce(F.col("_within"), F.col("_carry")))
            .drop("_chunk", "_mark", "_within", "_carry"))


def inherited_postings(rows: DataFrame, part: str, order: str, group_col: str,
                       postings: DataFrame) -> DataFrame:
    """A member row gets its own words plus the words of its group's
    header row; a header keeps its own words.

    ``rows``: (part, order, group_col); ``postings``: (part, order, word).
    The header's postings are joined to every member of its group (equi join
    on part + header order)."""
    headers = postings.select(F.col(part), F.col(order).alias(group_col), "word")
    members = rows.where(F.col(group_col).isNotNull() & (F.col(order) != F.col(group_col)))
    from_header = members.select(part, order, group_col).join(headers, [part, group_col]).select(part, order, "word")
    return postings.select(part, order, "word").unionByName(from_header).distinct()


# --- T5 / W5 / T8 on catalogue pages: course blocks and sequences ------------------------

# A page is read as a sequence of tokens: div tags and what lies between them.
# A course-block div (its class is exactly one of the two texts, wherever the
# attribute stands) runs to its own close tag, other divs in it included.
# Whitespace between blocks is ignored, so a subsequence block belongs to the
# main block before it when only whitespace and other subsequence blocks lie in
# between.
BLOCK_CLASS_RE = r"""(?is)^<div(?=\s)[^>]*?\sclass\s*=\s*["']courseblock\s+(main|subsequence)["']"""


def _p_text(block: Column, css: str) -> Column:
    return html_text(F.regexp_extract(block, rf"""(?is)<p(?=\s)[^>]*?\sclass\s*=\s*["']{css}["'][^>]*>(.*?)</p\s*>""", 1))


def _block_items(html: Column) -> Column:
    """array<struct<k, t>> of a page: course blocks (k = main or subsequence,
    t = inner html) and, with k = '', anything else that is not whitespace."""
    tokens = tag_tokens(html, "div")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("kind"), F.lit("").alias("cur"),
                     F.array().cast("array<struct<k:string,t:string>>").alias("out"))

    def step(s, t):
        opens, closes = t.rlike(r"(?is)^<div(?=[\s/>])"), t.rlike(r"(?is)^</div(?=[\s/>])")
        kind = F.lower(F.regexp_extract(t, BLOCK_CLASS_RE, 1))
        inside = s["depth"] > 0
        begins = ~inside & (kind != "")
        ends = closes & (s["depth"] == 1)
        depth = (F.when(begins, F.lit(1)).when(inside & opens, s["depth"] + 1).when(inside & closes, s["depth"] - 1)
                 .otherwise(s["depth"]))
        cur = F.when(begins | ends | ~inside, F.lit("")).otherwise(F.concat(s["cur"], t))
        item = F.when(ends, F.struct(s["kind"].alias("k"), s["cur"].alias("t"))).when(
            ~inside & ~begins & t.rlike(r"\S"), F.struct(F.lit("").alias("k"), F.lit("").alias("t")))
        out = F.when(item.isNotNull(), F.concat(s["out"], F.array(item))).otherwise(s["out"])
        return F.struct(depth.alias("depth"), F.when(begins, kind).otherwise(s["kind"]).alias("kind"), cur.alias("cur"), out.alias("out"))

    return F.aggregate(tokens, start, step, lambda s: F.when(
        s["depth"] > 0, F.concat(s["out"], F.array(F.struct(s["kind"].alias("k"), s["cur"].alias("t"))))).otherwise(s["out"]))


def course_blocks(pages: DataFrame, key_width: int = 10) -> DataFrame:
    """T5 + W5 for catalogue pages: every ``courseblock main`` and
    ``courseblock subsequence`` div of a page, in page order, with the
    position of the main block heading its sequence (null for a main block
    or an orphan subsequence). Title = ``courseblocktitle`` paragraph text,
    description = ``courseblockdesc`` text; code = first ``key_width``
    characters of the trimmed title (T6).

    Grouping is done inside each page's row (a page is one row), so no
    window or shuffle is needed and a page's size bounds the work."""
    items = pages.select("page_id", _block_items(markup(F.col("html"))).alias("items"))
    kinds = F.transform("items", lambda x: x["k"])
    # fold: state = (current header position or 0, array of header positions)
    empty = F.array().cast("array<int>")

    def step(acc, k):
        i = F.size(acc["heads"]) + 1
        head = (F.when(k == "main", i)
                .when((k == "subsequence") & (acc["cur"] > 0), acc["cur"])
                .otherwise(F.lit(0)))
        return F.struct(head.alias("cur"), F.concat(acc["heads"], F.array(head)).alias("heads"))

    heads = F.aggregate(kinds, F.struct(F.lit(0).alias("cur"), empty.alias("heads")), step)["heads"]
    rows = items.select("page_id", F.posexplode(F.arrays_zip("items", heads.alias("h"))).alias("pos0", "z"))
    rows = rows.where(F.col("z.items.k") != "").select(
        "page_id", (F.col("pos0") + 1).alias("pos"), F.col("z.items.k").alias("kind"),
        F.when((F.col("z.items.k") == "subsequence") & (F.col("z.h") > 0), F.col("z.h")).alias("header_pos"),
        F.col("z.items.t").alias("block"))
    title = _p_text(F.col("block"), "courseblocktitle")
    return rows.select("page_id", "pos", "kind", "header_pos",
                       title_key(title, key_width).alias("code"),
                       title_rest(title, key_width).alias("title_text"),
                       _p_text(F.col("block"), "courseblockdesc").alias("desc_text"))


def course_postings(blocks: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """T7 + T8 + G6 on course blocks: every block keeps its own title and
    description words; a subsequence block also gets its header's words.
    Output distinct (page_id, code, word)."""
    own = text_postings(blocks, ["page_id", "pos", "code"], ["title_text", "desc_text"], stop_words, unique=True)
    headers = own.select("page_id", F.col("pos").alias("header_pos"), "word")
    members = blocks.where(F.col("header_pos").isNotNull()).select("page_id", "pos", "code", "header_pos")
    inherited = members.join(headers, ["page_id", "header_pos"]).select("page_id", "pos", "code", "word")
    return own.unionByName(inherited).select("page_id", "code", "word").distinct()

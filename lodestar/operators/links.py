"""Link graph crawling (job A): link extraction (T1), resolution (T2-T4),
follow filter (F13), and the bounded breadth-first crawl (I1) with its
visited anti join (J12) and FIFO first-discovery order (W6).

The frontier of depth d joins the edge table; links that may not be followed
or have no page (a failed fetch) are dropped, the first discovery of each url
stays, and visited urls go. Discovery order is a rank: a level is dealt into
ranges of (rank of the first parent, link position), the order a FIFO queue
would visit it in, so the key is one long at every depth. The visited urls are
one table in buckets by hash of the url, to which each level is appended; a
level reads only the buckets that its candidates fall into. The page budget
takes the first keys of the last level (the one place a limit is the feature;
ranked by ranges, so its size does not matter). Every level is written to the
shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import decode_entities, markup
from lodestar.functions.url import Url, ok_to_follow, part_names, remove_fragment, resolve_link, with_parts
from lodestar.session import cut_lineage, first_by, materialize, new_path

# An anchor's open tag up to the value of its href: whole attribute names, any
# of the three quoting forms, any attribute order.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
HREF_RE = (r"(?is)<a(?:\s+(?!href[\s=/>])[^\s=>\"'/]+(?:\s*=\s*" + _VALUE + r")?|\s*/)*+\s+href\s*=\s*(" + _VALUE + ")")


def extract_links(pages: DataFrame) -> DataFrame:
    """Every anchor href of every page with its position (0-based),
    character references decoded."""
    found = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all(markup(F.col("html")), F.lit(HREF_RE), 1)).alias("pos", "raw"))
    quoted = F.substring("raw", 1, 1).isin('"', "'")
    bare = F.when(quoted, F.substr("raw", F.lit(2), F.length("raw") - 2)).otherwise(F.col("raw"))
    return found.select("page_id", "url", "pos", decode_entities(bare).alias("href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """T2 + T3 + T4: fragment removed, then resolved against the page's own
    url; links that cannot be resolved (null) are dropped. Each text is parsed
    once, in a column of its own."""
    step = with_parts(with_parts(links, "url", "_base_"), "href", "_ref_")
    step = step.withColumn("_bare", remove_fragment(Url(F.col("href"), "_ref_")))
    # a link is null exactly for an empty reference or a page url without a
    # host; the test stands here because a filter on the finished link would be
    # pushed down with the whole resolution in it
    step = step.where((F.col("_bare") != "") & (F.col("_base_authority") != ""))
    step = with_parts(step, "_bare", "_bare_")
    out = step.withColumn("link", resolve_link(Url(F.col("url"), "_base_"), Url(F.col("_bare"), "_bare_")))
    return out.drop("_bare", *part_names("_base_", "_ref_", "_bare_"))


def follow_flags(links: DataFrame, domain: str, column: str = "link") -> DataFrame:
    """F13 as a flag column ``ok``."""
    step = with_parts(links, column, "_link_")
    return step.withColumn("ok", ok_to_follow(Url(F.col(column), "_link_"), domain)).drop(*part_names("_link_"))


def page_edges(pages: DataFrame) -> DataFrame:
    """T1-T4 composed: (src, pos, dst) for the links of the given pages."""
    resolved = resolve_links(extract_links(pages))
    return resolved.select(F.col("url").alias("src"), "pos", F.col("link").alias("dst"))


class VisitedUrls:
    """Urls in buckets by hash, one folder a bucket; ``add`` appends rows,
    ``without`` reads the buckets of its candidates and no others. The driver
    holds one bit per bucket."""

    def __init__(self, spark, buckets: int = 32):
        if not 1 <= buckets <= 62:
            raise ValueError("1 to 62 buckets: their set is kept in one long")
        self.spark, self.buckets, self.path, self.filled = spark, buckets, new_path(spark, "visited"), 0

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("url"), F.lit(self.buckets)).cast("int")

    def touched(self) -> Column:
        """Aggregate: the buckets of a table of urls, as bits of a long."""
        return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), self.bucket())).alias("touched")

    def add(self, urls: DataFrame, touched: int) -> None:
        rows = urls.select("url", self.bucket().alias("bucket"))
        # rebalanced: one file a bucket where it is small, several where it is not
        rows.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(self.path)
        self.filled |= touched

    def read(self, touched: int) -> DataFrame | None:
        wanted = [f"{self.path}/bucket={b}" for b in range(self.buckets) if (self.filled & touched) >> b & 1]
        if not wanted:
            return None
        return self.spark.read.schema("url string, bucket int").option("basePath", self.path).parquet(*wanted)

    def without(self, urls: DataFrame, touched: int) -> DataFrame:
        seen = self.read(touched)
        if seen is None:
            return urls
        # joined on bucket and url, so that both sides meet bucket by bucket
        return urls.withColumn("bucket", self.bucket()).join(seen, ["bucket", "url"], "left_anti").drop("bucket")


def _ranked(level: DataFrame) -> DataFrame:
    """(url, depth, parent, pos) -> (url, depth, key): one long per row that
    orders the level by (parent, pos). Ranges are sorted each on its own, the
    number of the range stands in the high bits."""
    order = ["parent", "pos", "url"]
    dealt = level.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("url", "depth", F.monotonically_increasing_id().alias("key"))


def crawl(pages: DataFrame, edges: DataFrame, seed_url: Column | str, domain: str,
          max_pages: int | None = None, max_depth: int | None = None, buckets: int = 32) -> DataFrame:
    """Breadth-first crawl from ``seed_url`` over ``edges(src, pos,
    dst)``, following only urls accepted by F13 for ``domain`` and present
    in ``pages(url, ...)``. At most ``max_pages`` pages (all reachable when
    None). Output: url, depth, key (long; FIFO order within a depth)."""
    spark = pages.sparkSession
    # the page urls and the edges that may be followed to a page are read once
    # per crawl, not per level
    known = cut_lineage(pages.select("url").distinct().where(ok_to_follow(F.col("url"), domain)))
    e = cut_lineage(edges.select(F.col("src").alias("url"), "pos", "dst")
                    .join(known.select(F.col("url").alias("dst")), "dst", "left_semi"))
    visited = VisitedUrls(spark, buckets)
    seed = spark.range(1).select(
        (seed_url if isinstance(seed_url, Column) else F.lit(seed_url)).alias("url"),
        F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("key"))
    frontier, n_visited, row = materialize(seed.join(known, "url", "left_semi"), [visited.touched()])
    levels, n_new, depth = [frontier], n_visited, 0
    while n_new > 0 and (max_pages is None or n_visited < max_pages) and (max_depth is None or depth < max_depth):
        visited.add(frontier, row["touched"])
        first = F.min(F.struct(F.col("key").alias("parent"), "pos")).alias("first")
        cand = (frontier.join(e, "url").groupBy(F.col("dst").alias("url")).agg(first)
                .select("url", F.lit(depth + 1).alias("depth"), "first.parent", "first.pos"))
        cand, n_cand, touched = materialize(cand, [visited.touched()])
        if n_cand == 0:
            break
        frontier, n_new, row = materialize(_ranked(visited.without(cand, touched["touched"])), [visited.touched()])
        if max_pages is not None and n_visited + n_new > max_pages:
            # the page budget: the first keys of the last level only (top-k)
            frontier, n_new = materialize(first_by(frontier, "key", max_pages - n_visited))
        levels.append(frontier)
        n_visited += n_new
        depth += 1
    return reduce(DataFrame.unionByName, levels)


def crawl_index(pages: DataFrame, edges: DataFrame, seed_url, domain: str, code_map: DataFrame,
                max_pages: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Crawl from the seed, index the course blocks of the visited pages,
    map codes to ids. Returns (index (id, word), unmapped codes); the index
    goes to ``sinks.write_index`` as ``id|word`` rows."""
    from lodestar.operators.index import map_codes, page_blocks, text_postings, unmapped_codes
    visited = crawl(pages.select("url"), edges, seed_url, domain, max_pages=max_pages)
    fetched = pages.join(visited.select("url"), "url", "left_semi")
    postings = text_postings(page_blocks(fetched), ["code"], ["title_text", "desc_text"])
    return map_codes(postings, code_map), unmapped_codes(postings, code_map)

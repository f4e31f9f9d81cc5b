"""Crawl queries (job A) over ``pages``.

T1-T4 and F13 run on the real anchors of every page. The page hrefs never
point inside the page set, so two graphs stand in for it, N = number of
fetchable pages; in both the follow filter decides which urls may be visited:

- ``crawl_links`` walks the links that stand in the pages: an anchor is
  extracted, resolved and passed by the follow filter, and each of PROBES hashes
  of the resolved url mod N names a page that it leads to;
- the others walk page i -> pages (a*i + b) mod N for the (a, b) rules below,
  in that position order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.url import ARCHIVE_PREFIXES, URL_RE, ok_to_follow
from lodestar.operators import links as LN
from lodestar.session import cut_lineage
from lodestar.sources.tables import fetchable_pages, load

DOMAIN = "example.com"
BUDGET = 20
# Fixed values of this binding: derived link rules (a, b) -> (a*i + b) mod N.
EDGE_RULES = ((3, 1), (7, 2)) + tuple((1, d) for d in range(1, 9))
# Pages that one resolved link leads to in crawl_links.
PROBES = 4


def links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, pos, href) of every anchor."""
    return LN.extract_links(load(spark, sf_dir, "pages")).select("page_id", "pos", "href")


def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + T3 + T4: absolute link of every anchor."""
    return LN.resolve_links(LN.extract_links(load(spark, sf_dir, "pages"))).select("page_id", "pos", "link")


def links_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F13 on the resolved links and on the page urls themselves."""
    links = LN.resolve_links(LN.extract_links(load(spark, sf_dir, "pages")))
    own = load(spark, sf_dir, "pages").select("page_id", F.lit(-1).alias("pos"), F.col("url").alias("link"))
    both = links.select("page_id", "pos", "link").unionByName(own)
    return LN.follow_flags(both, DOMAIN)


def _graph(spark, sf_dir):
    p = fetchable_pages(load(spark, sf_dir, "pages")).select("page_id", "url")
    n = p.select(F.count(F.lit(1))).scalar()
    targets = p.select(F.col("url").alias("src"), F.explode(F.array(*[
        F.struct(F.lit(pos).alias("pos"), F.pmod(F.col("page_id") * a + b, n).alias("dst_id"))
        for pos, (a, b) in enumerate(EDGE_RULES)])).alias("t"))
    edges = (targets.select("src", "t.pos", "t.dst_id")
             .join(p.select(F.col("page_id").alias("dst_id"), F.col("url").alias("dst")), "dst_id")
             .select("src", "pos", "dst"))
    seed = p.where(ok_to_follow(F.col("url"), DOMAIN)).select(F.min_by("url", "page_id")).scalar()
    return p, edges, seed


def crawl_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + J12 + W6: every page reachable from the seed through followable
    links, with its breadth-first depth."""
    p, edges, seed = _graph(spark, sf_dir)
    visited = LN.crawl(p, edges, seed, DOMAIN)
    return visited.join(p, "url").select("page_id", "url", "depth")


def crawl_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 with a page budget: the first pages in FIFO visiting order."""
    p, edges, seed = _graph(spark, sf_dir)
    visited = LN.crawl(p, edges, seed, DOMAIN, max_pages=BUDGET)
    return visited.join(p, "url").select("page_id", "url", "depth")


def _link_graph(spark, sf_dir):
    p = fetchable_pages(load(spark, sf_dir, "pages"))
    ids = p.select("page_id", "url")
    n = ids.select(F.count(F.lit(1))).scalar()
    # written once: a filter on the finished link would be pushed down with the
    # whole resolution in it
    links = LN.follow_flags(cut_lineage(LN.page_edges(p), "links"), DOMAIN, "dst").where("ok")
    def page_of(k):
        return F.conv(F.substring(F.md5(F.concat(F.col("dst"), F.lit(f"#{k}"))), 1, 8), 16, 10).cast("bigint") % n
    probes = F.explode(F.array(*[F.struct((F.col("pos") * PROBES + k).alias("place"), page_of(k).alias("page_id")) for k in range(PROBES)]))
    edges = (links.select("src", probes.alias("t")).select("src", "t.place", "t.page_id")
             .join(ids, "page_id").select("src", F.col("place").alias("pos"), F.col("url").alias("dst")))
    seed = ids.where(ok_to_follow(F.col("url"), DOMAIN)).select(F.min_by("url", "page_id")).scalar()
    return ids, edges, seed


def crawl_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 over T1 to T4 and F13: every page reachable from the seed through the
    links that stand in the pages."""
    p, edges, seed = _link_graph(spark, sf_dir)
    return LN.crawl(p, edges, seed, DOMAIN).join(p, "url").select("page_id", "url", "depth")


def crawl_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl, index the visited pages' blocks, map codes to ids."""
    from lodestar.plans.index_plans import _code_map
    _, edges, seed = _graph(spark, sf_dir)
    pages = fetchable_pages(load(spark, sf_dir, "pages"))
    index, _ = LN.crawl_index(pages, edges, seed, DOMAIN, _code_map(spark, sf_dir))
    return index


QUERIES = {
    "crawl_index": crawl_index,
    "links_extract": links_extract,
    "links_resolved": links_resolved,
    "links_follow": links_follow,
    "crawl_bfs": crawl_bfs,
    "crawl_budget": crawl_budget,
    "crawl_links": crawl_links,
}

# ---------------------------------------------------------------------------
# DuckDB oracles (the same RFC 3986 expression; RE2 accepts it unchanged)


def _part(u: str, g: int) -> str:
    return f"regexp_extract({u}, '{URL_RE}', {g})"


def _ok_sql(u: str) -> str:
    auth = _part(u, 4)
    path = _part(u, 5)
    last = f"regexp_extract({path}, '([^/]*)$', 1)"
    body = f"regexp_replace({last}, '^\\.+', '')"
    ext = f"regexp_extract({body}, '(\\.[^.]*)$', 1)"
    blocked = " AND ".join(f"NOT starts_with({u}, '{p}')" for p in ARCHIVE_PREFIXES)
    return (f"coalesce(NOT contains({u}, 'mailto:') AND NOT contains({u}, '@') AND {blocked} "
            f"AND lower({_part(u, 2)}) IN ('http', 'https') AND {auth} <> '' "
            f"AND {_part(u, 9)} = '' AND {_part(u, 7)} = '' "
            f"AND ({auth} = '{DOMAIN}' OR ends_with({auth}, '.{DOMAIN}')) "
            f"AND {ext} IN ('', '.html'), false)")


_OPEN_A = "(?is)<a\\s[^>]*>"
_HREF = "(?is)\\shref\\s*=\\s*\"([^\"]*)\""

_EXTRACT = f"""
ex AS (SELECT page_id, url, [replace(regexp_extract(a, '{_HREF}', 1), '&amp;', '&') FOR a IN regexp_extract_all(
  regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>', ' ', 'g'), '{_OPEN_A}') IF regexp_matches(a, '{_HREF}')] AS l FROM pages),
links AS (SELECT page_id, url, unnest(l) AS href, CAST(unnest(range(len(l))) AS INTEGER) AS pos FROM ex)
"""

# Resolution restated for the href shapes present in the pages (absolute,
# protocol-relative, host-like, 'www', root-relative); anything else yields
# no row here, so a mismatch would show as a row-count difference.
_RESOLVE = f"""
r0 AS (SELECT page_id, pos, url, regexp_replace(href, '#.*$', '') AS h FROM links),
resolved AS (SELECT page_id, pos, CASE
    WHEN h = '' OR {_part('url', 4)} = '' THEN NULL
    WHEN {_part('h', 4)} <> '' THEN h
    WHEN right(split_part({_part('h', 5)}, '/', 1), 4) IN ('.edu', '.org', '.com', '.net')
         OR starts_with(h, 'www') THEN 'http://' || h
    WHEN starts_with(h, '/') AND NOT contains(h, '/.') AND NOT contains(h, '//')
         THEN lower({_part('url', 2)}) || '://' || {_part('url', 4)} || h
  END AS link FROM r0)
"""

_GRAPH = f"""
p AS (SELECT page_id, url FROM pages WHERE html IS NOT NULL AND length(html) > 0),
n AS (SELECT count(*) AS n FROM p),
edges AS ({" UNION ALL ".join(
    f"SELECT a.url AS src, b.url AS dst FROM p a CROSS JOIN n JOIN p b ON b.page_id = ({a} * a.page_id + {b}) % n.n"
    for a, b in EDGE_RULES)}),
okp AS (SELECT url FROM p WHERE {_ok_sql('url')}),
seed AS (SELECT url FROM p WHERE {_ok_sql('url')} ORDER BY page_id LIMIT 1),
bfs(url, depth) AS (
  SELECT url, 0 FROM seed
  UNION
  SELECT e.dst, b.depth + 1 FROM bfs b JOIN edges e ON e.src = b.url JOIN okp o ON o.url = e.dst
  WHERE b.depth < (SELECT n FROM n))
"""

_LINK_GRAPH = f"""
p AS (SELECT page_id, url FROM pages WHERE html IS NOT NULL AND length(html) > 0),
n AS (SELECT count(*) AS n FROM p),
good AS (SELECT r.page_id, r.link FROM resolved AS r JOIN p USING (page_id) WHERE r.link IS NOT NULL AND {_ok_sql('r.link')}),
okp AS (SELECT page_id, url FROM p WHERE {_ok_sql('url')}),
edges AS ({" UNION ALL ".join(
    f"SELECT page_id AS src, CAST('0x' || substr(md5(link || '#{k}'), 1, 8) AS BIGINT) % n.n AS dst FROM good CROSS JOIN n" for k in range(PROBES))}),
seed AS (SELECT min(page_id) AS page_id FROM okp),
bfs(page_id, depth) AS (
  SELECT page_id, 0 FROM seed WHERE page_id IS NOT NULL
  UNION
  SELECT e.dst, b.depth + 1 FROM bfs b JOIN edges e ON e.src = b.page_id JOIN okp o ON o.page_id = e.dst
  WHERE b.depth < (SELECT count(*) FROM okp))
"""


def _budget_sql() -> str:
    """The crawl unrolled level by level; a page's place in the queue is the
    list of link positions on its first path."""
    levels = 12
    edges = " UNION ALL ".join(
        f"SELECT a.url AS src, {pos} AS pos, b.url AS dst FROM p a CROSS JOIN n JOIN p b ON b.page_id = ({a} * a.page_id + {b}) % n.n"
        for pos, (a, b) in enumerate(EDGE_RULES))
    views = [_GRAPH.split("edges AS")[0].rstrip().rstrip(","), f"edges AS ({edges})",
             f"okp AS (SELECT url FROM p WHERE {_ok_sql('url')})",
             f"l0 AS (SELECT url, [0] AS place FROM p WHERE {_ok_sql('url')} ORDER BY page_id LIMIT 1)"]
    for d in range(levels):
        seen = " UNION ALL ".join(f"SELECT url FROM l{k}" for k in range(d + 1))
        views.append(f"l{d + 1} AS (SELECT e.dst AS url, min(list_append(l.place, e.pos)) AS place FROM l{d} l JOIN edges e ON e.src = l.url "
                     f"JOIN okp o ON o.url = e.dst WHERE e.dst NOT IN ({seen}) GROUP BY e.dst)")
    found = " UNION ALL ".join(f"SELECT url, {d} AS depth, place FROM l{d}" for d in range(levels + 1))
    return ("WITH " + ",\n".join(v.lstrip() for v in views) + f", found AS ({found}), first AS (SELECT url, depth FROM found "
            f"ORDER BY depth, place LIMIT {BUDGET}) SELECT p.page_id, f.url, f.depth FROM first f JOIN p ON p.url = f.url")


def _crawl_index_sql():
    from lodestar.plans.index_plans import _BLOCKS
    return ("WITH RECURSIVE " + _GRAPH + "," + _BLOCKS + """
SELECT DISTINCT m.id, w.word FROM (SELECT DISTINCT url FROM bfs) v JOIN p ON p.url = v.url
JOIN page_words w ON w.page_id = p.page_id JOIN code_map m ON m.code = w.code""")


ORACLE = {
    "crawl_index": _crawl_index_sql(),
    "crawl_budget": _budget_sql(),
    "links_extract": "WITH " + _EXTRACT + "SELECT page_id, pos, href FROM links",
    "links_resolved": "WITH " + _EXTRACT + "," + _RESOLVE + "SELECT page_id, pos, link FROM resolved WHERE link IS NOT NULL",
    "links_follow": "WITH " + _EXTRACT + "," + _RESOLVE + f""", both_links AS (
  SELECT page_id, pos, link FROM resolved WHERE link IS NOT NULL
  UNION ALL SELECT page_id, -1, url FROM pages)
SELECT page_id, pos, link, {_ok_sql("link")} AS ok FROM both_links""",
    "crawl_bfs": "WITH RECURSIVE " + _GRAPH + """
SELECT p.page_id, b.url, min(b.depth) AS depth FROM bfs b JOIN p ON p.url = b.url GROUP BY ALL""",
    "crawl_links": "WITH RECURSIVE " + _EXTRACT + "," + _RESOLVE + "," + _LINK_GRAPH + """
SELECT p.page_id, p.url, min(b.depth) AS depth FROM bfs b JOIN p ON p.page_id = b.page_id GROUP BY ALL""",
}

"""URL stages as Column expressions: fragment removal (T2), absolute-url
test (T3), relative link resolution (T4) and the follow filter (F13).

Parsing uses the generic-syntax regular expression of RFC 3986 appendix B.
It is as lenient as Python's ``urlparse`` (a url with a space still has a
scheme and a host), unlike ``try_parse_url`` which returns nulls for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

URL_RE = r"^(([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"
_GROUP = {"scheme": 2, "authority": 4, "path": 5, "query": 7, "fragment": 9}

# Url prefixes the crawl never follows (two spellings of the
# catalogue's archive folder).
ARCHIVE_PREFIXES = (
    "https://www.classes.cs.uchicago.edu/archive/2015/winter"
    "/12200-1/new.collegecatalog.uchicago.edu/thecollege/archives",
    "http://www.classes.cs.uchicago.edu/archive/2015/winter"
    "/12200-1/new.collegecatalog.uchicago.edu/thecollege/archives",
)

# A first path segment ending in one of these is read as a host
# that only lacks the protocol.
HOST_SUFFIXES = (".edu", ".org", ".com", ".net")

# File extensions that may be followed ('' = none).
FOLLOW_EXTENSIONS = ("", ".html")


class Url:
    """A url's text and parts: columns made by ``with_parts``, or expressions
    over a plain text column."""

    def __init__(self, url: Column, prefix: str | None = None):
        self.text, self._prefix = url, prefix

    def __getitem__(self, part: str) -> Column:
        if self._prefix is not None:
            return F.col(f"{self._prefix}{part}")
        v = F.regexp_extract(self.text, URL_RE, _GROUP[part])
        return F.lower(v) if part == "scheme" else v


def with_parts(df: DataFrame, url: str, prefix: str) -> DataFrame:
    """``df`` with the parts of column ``url`` as columns of their own (absent
    parts are ''), so that each is parsed once however often it is used. (A
    struct would be taken apart by the optimizer and parsed again per use.)"""
    return df.withColumns({f"{prefix}{part}": Url(F.col(url))[part] for part in _GROUP})


def part_names(*prefixes: str) -> list[str]:
    return [f"{p}{part}" for p in prefixes for part in _GROUP]


def _url(x) -> Url:
    return x if isinstance(x, Url) else Url(x)


# Schemes whose urls carry a network location (Python's
# urllib list), used when a url is re-composed after fragment removal.
USES_NETLOC = ("", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
               "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp",
               "nfs", "git", "git+ssh", "ws", "wss", "itms-services")


def remove_fragment(url: Column | Url) -> Column:
    """T2 with ``urldefrag`` semantics: a url without '#' is unchanged; a url
    with one is re-composed from its parts without the fragment, which
    lower-cases the scheme, drops an empty query and an empty ';' parameter,
    and keeps '//' only with an authority, an explicit '//' path, or a
    network scheme with an empty or rooted path."""
    u = _url(url)
    url, s, a, q = u.text, u["scheme"], u["authority"], u["query"]
    p = F.regexp_replace(u["path"], "^(.*/)?([^/;]*);$", "$1$2")
    rooted = (p == "") | p.startswith("/")
    body = (F.when(a != "", F.concat(F.lit("//"), a, F.when(rooted, p).otherwise(F.concat(F.lit("/"), p))))
            .when(p.startswith("//"), F.concat(F.lit("//"), p))
            .when((s != "") & s.isin(*USES_NETLOC) & rooted, F.concat(F.lit("//"), p))
            .otherwise(p))
    out = F.concat(F.when(s != "", F.concat(s, F.lit(":"))).otherwise(F.lit("")), body,
                   F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.when(url.contains("#"), out).otherwise(url)


def is_absolute(url: Column | Url) -> Column:
    """Non-empty and has an authority."""
    u = _url(url)
    return F.coalesce((F.length(u.text) > 0) & (F.length(u["authority"]) > 0), F.lit(False))


def _resolve_path(base_path: Column, ref_path: Column) -> Column:
    """Merge a reference path into a base path and remove dot segments, the
    way Python's urljoin does (empty middle segments are dropped too)."""
    base_parts = F.split(base_path, "/", -1)
    base_dir = F.when(F.element_at(base_parts, -1) != "",
                      F.slice(base_parts, 1, F.greatest(F.size(base_parts) - 1, F.lit(0)))
                      ).otherwise(base_parts)
    ref_parts = F.split(ref_path, "/", -1)
    rooted = ref_path.startswith("/")
    merged = F.concat(base_dir, ref_parts)
    n = F.size(merged)
    # a relative reference merged with the base loses empty middle segments;
    # a root-relative path keeps them (as urljoin does)
    middle = F.filter(F.slice(merged, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != "")
    merged = F.when(n <= 2, merged).otherwise(
        F.concat(F.slice(merged, 1, 1), middle, F.slice(merged, -1, 1)))
    segs = F.when(rooted, ref_parts).otherwise(merged)
    empty = F.array().cast("array<string>")

    def step(acc, s):
        return (F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                .when(s == ".", acc)
                .otherwise(F.concat(acc, F.array(s))))

    resolved = F.aggregate(segs, empty, step)
    resolved = F.when(F.element_at(segs, -1).isin(".", ".."),
                      F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    joined = F.array_join(resolved, "/")
    # with an authority present the path always starts with '/'
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def url_join(base: Column | Url, ref: Column | Url) -> Column:
    """RFC 3986 reference resolution (Python ``urljoin`` semantics) for a
    reference without a fragment."""
    b, r = _url(base), _url(ref)
    prefix = F.concat(b["scheme"], F.lit("://"), b["authority"])
    r_has_query = r.text.contains("?")

    def q(v, present):
        return F.when(present, F.concat(F.lit("?"), v)).otherwise(F.lit(""))

    # a reference with the base's own scheme is read without it
    ref_no_scheme = F.when(r["scheme"] == b["scheme"],
                           F.substr(r.text, F.length(r["scheme"]) + 2)).otherwise(r.text)
    ref_no_scheme = F.when(r["scheme"] != "", ref_no_scheme).otherwise(r.text)
    return (
        F.when(r.text == "", b.text)
        .when((r["scheme"] != "") & (r["scheme"] != b["scheme"]), r.text)
        .when(ref_no_scheme.startswith("//") & (r["authority"] != ""),
              F.concat(b["scheme"], F.lit(":"), ref_no_scheme))
        .when(r["path"] == "",
              F.concat(prefix, b["path"],
                       F.when(r_has_query, q(r["query"], F.lit(True)))
                       .otherwise(q(b["query"], b.text.contains("?")))))
        .otherwise(F.concat(prefix, _resolve_path(b["path"], r["path"]), q(r["query"], r_has_query)))
    )


def resolve_link(current: Column | Url, link: Column | Url) -> Column:
    """T4 ``convert_if_relative_url``: null when the link is empty or the
    current url is not absolute; an absolute link as is; a first path
    segment that looks like a host, or a link starting with 'www', gets
    'http://'; anything else is joined to the current url."""
    cur, new = _url(current), _url(link)
    first_seg = F.get(F.split(new["path"], "/", 2), 0)
    looks_like_host = F.substring(first_seg, -4, 4).isin(*HOST_SUFFIXES)
    return (
        F.when((new.text == "") | ~is_absolute(cur), F.lit(None).cast("string"))
        .when(is_absolute(new), new.text)
        .when(looks_like_host | new.text.startswith("www"), F.concat(F.lit("http://"), new.text))
        .otherwise(url_join(cur, new))
    )


def path_extension(path: Column) -> Column:
    """``os.path.splitext`` extension of the last path segment: leading dots
    of the segment do not start an extension."""
    last = F.regexp_extract(path, "([^/]*)$", 1)
    body = F.regexp_replace(last, "^\\.+", "")
    return F.regexp_extract(body, "(\\.[^.]*)$", 1)


def ok_to_follow(url: Column | Url, domain: str, blocked_prefixes=ARCHIVE_PREFIXES) -> Column:
    """F13 ``is_url_ok_to_follow``: no 'mailto:', no '@', not under a blocked
    prefix, scheme http/https, non-empty authority, no fragment, no query,
    authority equal to the domain or a subdomain of it, extension '' or
    '.html'. A null url is not followed."""
    u = _url(url)
    blocked = F.lit(False)
    for p in blocked_prefixes:
        blocked = blocked | u.text.startswith(p)
    cond = (
        ~u.text.contains("mailto:") & ~u.text.contains("@") & ~blocked
        & u["scheme"].isin("http", "https")
        & (u["authority"] != "")
        & (u["fragment"] == "")
        & (u["query"] == "")
        & ((u["authority"] == domain) | u["authority"].endswith("." + domain))
        & path_extension(u["path"]).isin(*FOLLOW_EXTENSIONS)
    )
    return F.coalesce(cond, F.lit(False))

"""Main text of raw web pages by line-block distribution.

Markup is stripped into lines, one per block of text. A line's weight is the
length of its text, or nothing if most of it is links; menus, headers, footers, side bars, notices,
adverts, forms and reader comments leave a gap of ``WINDOW`` lines without
weight (but for an element of that kind that holds the page's marked part and
half of its text). Over the lines slides a window of ``WINDOW`` lines
that sums their weights: text surges where the sum rises from nothing and
dives where it falls to nothing again, and the lines between are kept. Where a page marks its
article (or main part), the highest window sum of that part, times
``MARKED_BONUS``, is held against the highest one of the other lines. If it is
at least as high, that part's lines are kept but for windows full of links (a menu
in it); otherwise the mark belongs to a teaser or card and the page is read as
one without marks: a run must reach an absolute floor or end a sentence, and if
none does, the highest is kept.

Defined results: null and empty html give an empty text; tags that are never
closed end where html ends them (a paragraph at the next block) or else with
the page; text is not cut or capped; repeated rows are extracted alike; an
input column named like a result column is replaced."""

from __future__ import annotations

import re
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
#: a run on a page without marks has a window of this many characters, or a line that ends a sentence
FLOOR = 25
MARKED_BONUS = 4
SENTENCE_ENDS = (".", "!", "?", "…", ":", "。")

# Element names of the html standard by role.
_BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
             "search section summary table tbody tfoot thead title tr ul".split())
_SPACE = {"br", "td", "th", "wbr"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_NEVER_TEXT = set("head nav footer aside form menu dialog button select fieldset object video audio canvas search".split())
_ALWAYS_AROUND = {"head", "nav", "footer", "button", "select", "menu"}
_MAIN = {"article", "main"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
_ENDED_BY_BLOCK = {"p", "li", "dt", "dd"}
# Roles, and words of class and id names, of parts around an article.
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
_COMMENT_WORDS = {"comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion"}
_NAMES = _COMMENT_WORDS | set(
    "ad ads advert adverts advertisement adsense banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notification popup promo promoted related share sharing "
    "sidebar social sponsor sponsored subscribe toolbar widget".split())
# Words that class names of such parts add to the words above.
_BOXES = set("area bar bottom box button buttons column container content global icons inner item items left links list main nav "
             "page panel post posts right section signup site slot top unit wrap wrapper".split())
_NAMED = set("aside center details div dl figure footer header iframe li nav ol p section span table ul".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|math|textarea|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_WORD = re.compile(r"[a-z0-9]+")


def _tokens(html: str) -> list[tuple]:
    """(kind, name, attributes or text): kind is 't' text, 'o' open, 'c' close."""
    out, at = [], 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            out.append(("t", "", html[at:m.start()]))
        at = m.end()
        if m[3]:
            out.append(("c" if m[2] else "o", m[3].lower(), m[4]))
    if at < len(html):
        out.append(("t", "", html[at:]))
    return out


def _ends(tokens: list[tuple]) -> dict[int, int]:
    """Position of the close tag of each open tag that has one; a paragraph or
    list item without one ends at the next block."""
    stacks: dict[str, list[int]] = {}
    end: dict[int, int] = {}
    loose: dict[str, int] = {}
    for i, (kind, name, _) in enumerate(tokens):
        if kind == "t":
            continue
        if name in _BLOCK and "p" in loose:
            end[loose.pop("p")] = i
        if kind == "o" and name not in _VOID:
            if name in _ENDED_BY_BLOCK and name in loose:
                end[loose.pop(name)] = i
            if name in _ENDED_BY_BLOCK:
                loose[name] = i
            else:
                stacks.setdefault(name, []).append(i)
        elif kind == "c":
            if name in loose:
                end[loose.pop(name)] = i
            elif stacks.get(name):
                end[stacks[name].pop()] = i
    return end


def _around(name: str, attributes: str) -> bool:
    """Whether an element stands around an article by its own name, role,
    class, id or visibility."""
    if name in _NEVER_TEXT:
        return True
    if not attributes or not attributes.strip(" /\n\t"):
        return False
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    if values.get("role") in _ROLES or "hidden" in values or "display:none" in values.get("style", "").replace(" ", ""):
        return True
    wanted = _NAMES if name in _NAMED else _COMMENT_WORDS if name == "article" else set()
    return bool(wanted) and any(_named(token, wanted) for token in f"{values.get('class', '')} {values.get('id', '')}".split())


def _named(token: str, wanted: set) -> bool:
    """Whether a class or id names a part by ``wanted`` words: it is made of
    them and of words for boxes alone, so neither has-sidebar nor share-price does."""
    words = set(_NAME_WORD.findall(token))
    return bool(words & wanted) and words <= wanted | _BOXES


def _unseen(attributes: str) -> bool:
    values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    return "hidden" in values or "display:none" in values.get("style", "").replace(" ", "")


def _is_comment(attributes: str) -> bool:
    return any(_named(x.lower(), _COMMENT_WORDS) for m in _ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id")
               for x in (m[2] or m[3] or m[4] or "").split())


class _Holds:
    """What an element holds: whether a marked part, and how much of the
    page's text, each asked from running sums."""

    def __init__(self, tokens: list[tuple]):
        marked = [k == "o" and n in _MAIN and not _is_comment(rest) for k, n, rest in tokens]
        self.marked = [0, *accumulate(marked)]
        self.text = [0, *accumulate(len(rest.strip()) if k == "t" else 0 for k, _, rest in tokens)]

    def the_page(self, i: int, stop: int, rest: str) -> bool:
        """Whether the part around the article named by token ``i`` is the
        page itself: it holds the marked part and half of all text, or three
        quarters of the text of a page without marks."""
        if _is_comment(rest) or _unseen(rest):
            return False
        share = (self.text[stop] - self.text[i]) / max(1, self.text[-1])
        return share >= 0.5 if self.marked[stop] > self.marked[i] else not self.marked[-1] and share >= 0.75


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """(text, length of it inside links, inside the article); a part around
    the article gives ``WINDOW`` empty lines."""
    tokens = _tokens(html)
    end = _ends(tokens)
    holds = _Holds(tokens)
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked, in_link, main_end, skip_end, header_end = 0, False, [], -1, -1

    def flush():
        nonlocal linked
        if text:
            line = " ".join(unescape("".join(text)).split())
            if line:
                out.append((line, linked, bool(main_end)))
            text.clear()
        linked = 0

    i, n = 0, len(tokens)
    while i < n:
        kind, name, rest = tokens[i]
        while main_end and i >= main_end[-1]:
            flush()
            main_end.pop()
        if kind == "t":
            text.append(rest)
            linked += len(rest.strip()) if in_link else 0
        elif (kind == "o" and name not in _VOID and (_around(name, rest) or name == "header" and not main_end)
              and not (i in end and name not in _ALWAYS_AROUND and holds.the_page(i, end[i], rest))):
            stop = end.get(i)
            if stop is None:  # never closed: up to the article, or else only this tag
                stop = next((j for j in range(i + 1, n) if tokens[j][0] == "o" and tokens[j][1] in _MAIN), i + 1) - 1
            flush()
            out.extend([("", 0, False)] * WINDOW)
            if tokens[stop][0] == "o" and stop > i and tokens[stop][1] not in ("", name):
                stop -= 1  # ended by the next block, which is read as such
            elif tokens[stop][0] == "o" and stop > i:
                stop -= 1
            i = max(i, stop)
        elif kind == "o" and name == "header":
            # an article's own header: only its headings belong to the text
            stop = end.get(i, i)
            flush()
            for j in range(i + 1, stop):
                if tokens[j][0] == "o" and tokens[j][1] in _HEADING:
                    text.extend(t[2] for t in tokens[j + 1:end.get(j, j)] if t[0] == "t")
                    flush()
            i = max(i, stop)
        else:
            if name in _BLOCK:
                flush()
            elif name in _SPACE:
                text.append(" ")
            if name == "a":
                in_link = kind == "o"
            if kind == "o" and name in _MAIN:
                main_end.append(end.get(i, n))
        i += 1
    flush()
    return out


def _sums(weight: list[int]) -> list[int]:
    return [sum(weight[i:i + WINDOW]) for i in range(len(weight))]


def main_text(html: str) -> str:
    lines = lines_of(html)
    plain = [0 if 2 * k > len(t) else len(t) for t, k, _ in lines]
    inside = [w if m else 0 for w, (_, _, m) in zip(plain, lines, strict=True)]
    highest = max(_sums(inside), default=0)
    marked = highest > 0 and MARKED_BONUS * highest >= max(_sums([0 if m else w for w, (_, _, m) in zip(plain, lines, strict=True)]))
    weight = inside if marked else plain
    n = len(lines)
    sums = _sums(weight)
    if marked:
        text = [m and bool(t) for t, _, m in lines]
        # a window full of lines, none with weight of its own: a menu inside the part
        menu = [k + j for k in range(n - WINDOW + 1) if not sums[k] and all(text[k:k + WINDOW]) for j in range(WINDOW)]
        return "\n\n".join(lines[k][0] for k in sorted({k for k in range(n) if text[k]} - set(menu)))
    runs, i = [], 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        dive = i
        while dive < n and sums[dive]:
            dive += 1
        heavy = [k for k in range(i, dive) if weight[k]]
        ends = any(lines[k][0].endswith(SENTENCE_ENDS) for k in heavy)
        runs.append((ends or max(sums[i:dive]) >= FLOOR, max(sums[i:dive]), range(heavy[0], heavy[-1] + 1)))
        i = dive
    if runs and not any(good for good, _, _ in runs):
        runs = [(True, *max(runs, key=lambda r: r[1])[1:])]
    return "\n\n".join(lines[k][0] for good, _, run in runs if good for k in run if lines[k][0])


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars`` (code points)."""
    add = {text: "string", "n_chars": "bigint"}
    kept = [c for c in pages.columns if c not in (html, *add)]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name in kept]
                       + [f"`{k}` {v}" for k, v in add.items()])

    def run(batches):
        for b in batches:
            found = [main_text(x.as_py() or "") for x in b.column(b.schema.get_field_index(html))]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in kept]
                + [pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], kept + list(add))

    return pages.mapInArrow(run, schema)


def op10_line_blocks(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))

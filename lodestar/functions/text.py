"""Word processing as Column expressions: whitespace tokenising, lower-casing,
trailing-punctuation stripping and stop-word removal (T7, T13, F14), key
from a title (T6), and html-to-text helpers for block extraction (T5)."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The index ignore list. These 44 words must equal the
# reference's list for the index to contain the same words.
STOP_WORDS = (
    "a", "also", "an", "and", "are", "as", "at", "be", "but", "by", "course",
    "for", "from", "how", "i", "ii", "iii", "in", "include", "is", "not", "of",
    "on", "or", "s", "sequence", "so", "social", "students", "such", "that",
    "the", "their", "this", "through", "to", "topics", "units", "we", "were",
    "which", "will", "with", "yet",
)

# The characters Python's str.split() treats as whitespace,
# as (first, last) code point ranges. Java's and RE2's \s cover only ASCII,
# so the class is spelled out.
WHITESPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
)

# Trailing characters removed from a word (one of them, once).
TRAILING_PUNCT = "!.:"


def _java_class(ranges) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\u{lo:04X}" if lo == hi else f"\\u{lo:04X}-\\u{hi:04X}")
    return "[" + "".join(parts) + "]+"


def _re2_class(ranges) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:04X}}}" if lo == hi else f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}")
    return "[" + "".join(parts) + "]+"


WS_SPLIT_JAVA = _java_class(WHITESPACE_RANGES)
WS_SPLIT_RE2 = _re2_class(WHITESPACE_RANGES)   # the same class for DuckDB oracles
TRAILING_RE = "[" + "".join("\\" + c for c in TRAILING_PUNCT) + "]$"


def split_ws(text: Column) -> Column:
    """Split on runs of whitespace, dropping empty pieces (Python's
    argument-less ``str.split``)."""
    return F.filter(F.split(text, WS_SPLIT_JAVA), lambda w: F.length(w) > 0)


def normalize_word(word: Column) -> Column:
    """T7 for one word: lower-case, then remove one trailing ! . or :"""
    return F.regexp_replace(F.lower(word), TRAILING_RE, "")


def strip_word_ends(text: Column) -> Column:
    """T7 over a whole text in one pass: remove one ! . or : at the end of
    every word (a punctuation character followed by whitespace or the end)."""
    cls = WS_SPLIT_JAVA[:-1]
    return F.regexp_replace(text, f"[{re_escape_class(TRAILING_PUNCT)}](?={cls}|$)", "")


def re_escape_class(chars: str) -> str:
    return "".join("\\" + c for c in chars)


def index_words(text: Column, stop_words=STOP_WORDS, distinct: bool = False) -> Column:
    """T7 + F14 over a whole text: array of normalised words with empty
    words and stop words removed.

    The text is lower-cased and end-stripped once, then split (no per-word
    regex). ``distinct=True`` returns each word once (hash-based
    ``array_except`` against the stop list), which is all postings need."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    words = split_ws(strip_word_ends(F.lower(text)))
    if distinct:
        return F.array_except(words, stop)
    return F.filter(words, lambda w: ~F.array_contains(stop, w))


def title_key(title: Column, width: int = 10) -> Column:
    """The first ``width`` characters of the trimmed title, NBSP -> space."""
    return F.translate(F.substring(trim_ws(title), 1, width), "\u00a0", " ")


def title_rest(title: Column, width: int = 10) -> Column:
    """What follows the key in the trimmed title."""
    return F.substr(trim_ws(title), F.lit(width + 1))


def trim_ws(text: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace incl. NBSP."""
    cls = WS_SPLIT_JAVA[:-1]
    return F.regexp_replace(text, f"^{cls}+|{cls}+$", "")


ENTITY_RE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _named() -> Column:
    """The html standard's named character references, as one literal map
    (names end in ';' in the standard's own table)."""
    table = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def decode_entities(text: Column) -> Column:
    """Named and numeric character references of a text, each decoded once;
    unknown ones stay, nbsp becomes a space. Texts without any are untouched."""
    # split at the references: pieces[i] stands before refs[i]
    refs = F.regexp_extract_all(text, F.lit(ENTITY_RE), 0)
    pieces = F.split(text, ENTITY_RE, -1)

    def char(ref):
        body = F.substr(ref, F.lit(2), F.length(ref) - 2)
        point = F.when(F.lower(F.substring(body, 2, 1)) == "x", F.conv(F.substr(body, F.lit(3)), 16, 10)) \
            .otherwise(F.conv(F.substr(body, F.lit(2)), 10, 10)).cast("int")
        ok = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        numeric = F.when(ok, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
        return F.coalesce(F.when(body.startswith("#"), numeric).otherwise(F.try_element_at(_named(), body)), ref)

    joined = F.array_join(F.zip_with(pieces, F.concat(F.transform(refs, char), F.array(F.lit(""))), lambda p, c: F.concat(p, c)), "")
    joined = F.replace(joined, F.lit("\u00a0"), F.lit(" "))
    return F.when(text.contains("&") & (F.size(refs) > 0), joined).otherwise(text)


def html_text(fragment: Column) -> Column:
    """Visible text of an html fragment: script/style bodies and comments
    removed, tags replaced by a space, character references decoded."""
    out = F.regexp_replace(fragment, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    out = F.regexp_replace(out, "(?s)<!--.*?-->", " ")
    return decode_entities(F.regexp_replace(out, "<[^>]*>", " "))


#: Comments and the bodies of scripts and styles are no markup; one that is never closed ends with the text.
NOT_MARKUP_RE = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)"


def markup(html: Column) -> Column:
    """The html without what only looks like markup, in one scan from the
    start: a comment hides a script and the other way round."""
    return F.regexp_replace(html, NOT_MARKUP_RE, " ")


def tag_tokens(html: Column, tag: str) -> Column:
    """The html cut at the open and close tags of one element name: tags and
    what lies between them, in order (array)."""
    mark = "\u0001"
    return F.split(F.regexp_replace(html, rf"(?is)(</?{tag}(?=[\s/>])[^>]*>)", f"{mark}$1{mark}"), mark, -1)


def html_elements(html: Column, tag: str) -> Column:
    """Inner html of every outermost <tag> element, in order (array). Elements
    of the same name may be nested; one that is never closed ends with the
    text."""
    tokens = tag_tokens(html, tag)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))

    def step(s, t):
        opens, closes = t.rlike(rf"(?is)^<{tag}(?=[\s/>])"), t.rlike(rf"(?is)^</{tag}(?=[\s/>])")
        depth = F.when(opens, s["depth"] + 1).when(closes, F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"])
        ends = closes & (s["depth"] == 1)
        cur = F.when(s["depth"] == 0, F.lit("")).when(ends, F.lit("")).otherwise(F.concat(s["cur"], t))
        out = F.when(ends, F.concat(s["out"], F.array(s["cur"]))).otherwise(s["out"])
        return F.struct(depth.alias("depth"), cur.alias("cur"), out.alias("out"))

    return F.aggregate(tokens, start, step, lambda s: F.when(s["depth"] > 0, F.concat(s["out"], F.array(s["cur"]))).otherwise(s["out"]))


def html_element(html: Column, tag: str) -> Column:
    """Inner html of the first <tag>...</tag> element ('' when absent)."""
    return F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)

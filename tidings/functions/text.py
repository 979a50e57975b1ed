"""Text and URL columns. Everything here is a plain Column expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Headings of blocks cut from article bodies, preview length.
STRIP_BLOCKS = ("Похожие", "Видео")
PREVIEW_BYTES = 350

ASCII_SPACE = r"[\t\n\f\r ]"


def trim_space(c: Column) -> Column:
    """Trim Unicode white space (Spark's plain ``trim`` only drops U+0020)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def normalize_url(c: Column) -> Column:
    """Trim and drop the fragment; query strings and relative URLs stay."""
    return F.substring_index(trim_space(c), "#", 1)


def url_host(c: Column) -> Column:
    """Host with port, without user info; '' for relative URLs."""
    authority = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.substring_index(authority, "@", -1)


def strip_symbols(c: Column) -> Column:
    """Drop leading spaces, emoji and other non-ASCII outside А-Я, а-я."""
    return F.regexp_replace(c, r"^[^\x00-\x1F\x21-\x7Fа-яА-Я]++", "")


def tidy_space(c: Column, nbsp: bool = True, collapse: bool = True) -> Column:
    """NBSP to space, runs of ASCII white space to one space, trim."""
    if nbsp:
        c = F.replace(c, F.lit("\u00a0"), F.lit(" "))
    if collapse:
        # Single spaces, the usual case, do not match: nothing to rewrite there.
        c = F.regexp_replace(c, rf"[\t\n\f\r]{ASCII_SPACE}*+| {ASCII_SPACE}++", " ")
    return trim_space(c)


def preview(c: Column, max_bytes: int = PREVIEW_BYTES) -> Column:
    """Cut to ``max_bytes`` UTF-8 bytes at the last space and add an ellipsis."""
    raw = F.encode(c, "UTF-8")
    # A letter has at most four bytes, so one of these ends on a whole letter.
    head = F.coalesce(*[
        F.try_validate_utf8(F.substring(raw, 1, max_bytes - k).cast("string")) for k in range(4)
    ])
    tail = F.instr(F.reverse(head), " ")
    at_space = (tail > 0) & (tail < F.char_length(head))
    shown = F.when(at_space, F.left(head, F.char_length(head) - tail)).otherwise(head)
    return F.when(F.octet_length(c) <= max_bytes, c).otherwise(F.concat(shown, F.lit("…")))


def first_nonblank(candidates: Column) -> Column:
    """First candidate that is neither NULL nor '' (fallback lists); '' if none."""
    return F.coalesce(F.get(F.filter(candidates, lambda x: x != ""), F.lit(0)), F.lit(""))


def pick_srcset(value: Column) -> Column:
    """First listed URL of a ``srcset`` that is no data URI, else the whole value."""
    urls = F.transform(
        F.split(value, ","),
        lambda part: F.regexp_extract(trim_space(part), r"^[^\s\x85\p{Z}]+", 0),
    )
    listed = F.filter(urls, lambda u: (u != "") & ~F.startswith(u, F.lit("data:")))
    return F.coalesce(F.get(listed, F.lit(0)), value)


def image_value(value: Column, attr: Column) -> Column:
    """Apply the ``srcset`` rule where the value came from that attribute."""
    return F.when(attr == "srcset", pick_srcset(value)).otherwise(value)


def _one_argument(body, name: str):
    return lambda page: body(page, name)


def strip_blocks(c: Column, names: tuple[str, ...] = STRIP_BLOCKS) -> Column:
    """Cut div / section / aside blocks that carry one of the given headings.

    Possessive and atomic groups: every part can match in one way only, so the
    engine never backtracks over a long body and whole texts are processed.
    """
    def without(page: Column, name: str) -> Column:
        lit = r"\Q" + name + r"\E"
        cut = page
        for tag in ("div", "section"):
            heading = rf"(?:{ASCII_SPACE}*+<h\d[^>]*+>{lit}</h\d>|{lit})"
            cut = F.regexp_replace(
                cut, rf"(?iu)<{tag}[^>]*+>{heading}[^<]*+(?:(?!</{tag}>)<[^>]*+>)*+</{tag}>", "")
        cut = F.regexp_replace(
            cut, rf"(?iu)<aside[^>]*+>(?>[^<]*?{lit})[^<]*+(?:(?!</aside>)<[^>]*+>)*+</aside>", "")
        return F.when(F.rlike(page, F.lit(f"(?iu){lit}")), cut).otherwise(page)

    for name in names:
        # Bound once per name, so that the plan grows with the names' number only.
        c = F.get(F.transform(F.array(c), _one_argument(without, name)), F.lit(0))
    return c


# --- HTML to text, for flat markup -----------------------------------------

# Elements whose text is dropped.
RAW_HIDDEN = ("script", "style")
HIDDEN = ("nav", "footer")
# Character references decoded on the JVM side. '&amp;' is last,
# so that '&amp;lt;' becomes '&lt;' and not '<'.
REFERENCES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"),
    ("&laquo;", "\u00ab"), ("&raquo;", "\u00bb"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"),
    ("&hellip;", "\u2026"), ("&amp;", "&"),
)
# Those of them that also count without the semicolon.
LOOSE_REFERENCES = ("&lt", "&gt", "&quot", "&nbsp", "&copy", "&middot", "&laquo", "&raquo", "&amp")


def _element(tag: str) -> str:
    """An element, without its leading '<'."""
    return rf"{tag}(?=[\s/>])[^>]*+>.*?</{tag}\s*+>"


def drop_tags(c: Column) -> Column:
    """Drop tags. From a tag that stays open on, which no later one can end, the text is
    taken at once and kept, so that a page is passed over once whatever it holds."""
    return F.regexp_replace(c, r"(<[a-zA-Z/!?][^>]*+\z)|<[a-zA-Z/!?][^>]*+>", "$1")


def drop_raw(html: Column) -> Column:
    """Drop comments, scripts and styles, whichever opens first; none of them
    opens inside a title, which is kept.

    One of them that stays open is kept with all that follows: such a page is not
    flat, and the search for an end that is missing is made once.
    """
    html = F.replace(F.replace(html, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    parts = ["!--(?:-?+>|.*?--!?+>)", *map(_element, RAW_HIDDEN)]
    still_open = rf"<(?:!--|(?:{'|'.join(RAW_HIDDEN)}|title)(?=[\s/>])).*+"
    return F.regexp_replace(
        html, f"(?is)<(?:{'|'.join(parts)})|({'<' + _element('title')})|({still_open})", "$1$2")


def flat_text(body: Column) -> Column:
    """Text of flat markup (output of ``drop_raw``), white space untouched. A hidden
    element that stays open hides the rest."""
    hidden = "|".join(rf"{tag}(?=[\s/>])[^>]*+(?:\z|>.*?(?:</{tag}\s*+>|\z))" for tag in HIDDEN)
    return decode_references(drop_tags(F.regexp_replace(body, f"(?is)<(?:{hidden})", "")))


def decode_references(text: Column) -> Column:
    """Decode the listed character references, each text in one order of passes."""
    def loose(c, ref, shown):
        name = ref[:-1]
        return F.regexp_replace(c, f"{name};?" if name in LOOSE_REFERENCES else ref, shown)

    plain = reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), REFERENCES, text)
    unclosed = F.rlike(text, F.lit(rf"(?:{'|'.join(LOOSE_REFERENCES)})(?!;)"))
    return F.when(unclosed, reduce(lambda c, r: loose(c, *r), REFERENCES, text)).otherwise(plain)


def is_flat(body: Column) -> Column:
    """True where ``flat_text`` is exact, so no document tree is needed.

    Everything doubtful is excluded: advertisement classes, elements with raw
    text or text of their own order, hidden elements that repeat or stay open,
    angle brackets inside tags, and character references outside the list.
    """
    # All tests start at '<', so only tags cost anything. A tag that holds '<' or stays
    # open ends the search first, so the other tests look at one tag each.
    markup = "|".join([
        r"[a-z/!?][^<>]*+(?:<|\z)",
        r"(?:noscript|textarea|xmp|iframe|noembed|noframes|template|plaintext|svg|math|select|table"
        r"|frameset|script|style)[\s/>]",
        r"title[^>]*>[^<]*+(?:<(?!/title)|\z)",
        r"[a-z](?>[^>]*?class\s*+=)[^>]*(?:ads|advertisement)",
        r"[a-z][^<>]*=\s*(?:\"[^\"<>]*+[<>]|'[^'<>]*+[<>])",
        r"!--",
    ])
    known = "|".join(ref[1:] for ref, _ in REFERENCES)
    unknown = F.rlike(drop_tags(body), F.lit(rf"&(?!{known})[#a-zA-Z]"))
    return ~F.rlike(body, F.lit(f"(?is)<(?:{markup})")) & _closed_once(body) & ~unknown


def _closed_once(body: Column) -> Column:
    """Each hidden element occurs at most once, closed, and not in another one."""
    tags = F.regexp_extract_all(
        body, F.lit(rf"(?i)<(/?(?:{'|'.join(HIDDEN)}))(?=[\s/>])"), F.lit(1))
    one, two = (f"{t},/{t}" for t in HIDDEN)
    return F.lower(F.array_join(tags, ",")).isin("", one, two, f"{one},{two}", f"{two},{one}")

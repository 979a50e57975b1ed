"""A small document tree and selector matcher for the extraction tasks.

Only what the extraction rules use: tag, ``.class``, ``#id``, attribute tests,
descendant and child steps, comma groups. Elements are kept in document order,
so a subtree is a slice of the element list, and its text and its markup are
slices of two piece lists.

Time grows with the length of the page, whatever it holds. The scanner follows the
HTML standard where something stays open (a comment or raw text runs to the end
of the page, an open tag is dropped), so a search that finds no end is the last one.
Open elements are found by tag, and a selector passes over the elements once, in
document order, with the steps fulfilled so far handed down from the parent.
"""

import html
import re
from bisect import bisect_left
from collections import defaultdict

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes xmp".split())
TITLE_LIKE = frozenset(("title", "textarea"))
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
# Start tags that close an open element of the listed kinds, up to a boundary.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul"
    " li dd dt".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tbody", "thead", "tr"), "tfoot": ("tbody", "thead", "tr"),
}
P_BOUNDARY = frozenset("button caption html marquee object table td template th".split())
BOUNDARY = frozenset("ul ol dl table select template article section body html".split())
SPECIAL = BLOCKS | {"td", "th", "tr", "tbody", "body"}

TAG_NAME = re.compile(r"[a-zA-Z][^\t\n\r\f />]*")
COMMENT = re.compile(r"<!--(?:-?>|(.*?)--!?>)", re.S)
# An attribute, or nothing before the end of the tag. Quotes may lack their end on the last one of a page.
ATTRIBUTE = re.compile(
    r"""[\t\n\r\f /]*(=?[^\t\n\r\f />=]*)"""
    r"""(?:[\t\n\r\f ]*=[\t\n\r\f ]*(?:"([^"]*)"?|'([^']*)'?|([^\t\n\r\f >]*)))?""")
RAW_END = {tag: re.compile(rf"</{tag}[\t\n\r\f ]*>", re.I) for tag in RAW | TITLE_LIKE}


class Element:
    __slots__ = ("tag", "attrs", "classes", "parent", "pos", "end", "text_at", "text_end",
                 "out_at", "out_end")

    def __init__(self, tag, attrs, parent, pos):
        self.tag, self.attrs, self.parent, self.pos = tag, attrs, parent, pos
        self.classes = frozenset((attrs.get("class") or "").split())


class Document:
    def __init__(self, source):
        self.elements, self.texts, self.out, self.open = [], [], [], []
        self.open_at = defaultdict(list)  # tag -> its places among the open elements
        self.special_at = []              # places of the open elements of a special kind
        self.searches = {}
        self._scan(source.replace("\r\n", "\n").replace("\r", "\n"))
        self._pop_down_to(0)

    # -- scanning ---------------------------------------------------------

    def _scan(self, source):
        at, size = 0, len(source)
        while at < size:
            opens = source.find("<", at)
            if opens < 0:
                opens = size
            if opens > at:
                self._data(html.unescape(source[at:opens]))
            at = self._markup(source, opens) if opens < size else size

    def _markup(self, source, at):
        """Read what begins with the '<' at ``at``; where it ends."""
        name = TAG_NAME.match(source, at + 1)
        if name:
            return self._start_tag(source, name)
        mark = source[at + 1:at + 2]
        if mark not in ("/", "!", "?"):
            self._data("<")
            return at + 1
        if source.startswith("<!--", at):
            found = COMMENT.match(source, at)
            self.out.append(f"<!--{(found.group(1) or '') if found else source[at + 4:]}-->")
            return found.end() if found else len(source)
        end = source.find(">", at + 2)
        if end < 0:
            return len(source)
        name = TAG_NAME.match(source, at + 2, end) if mark == "/" else None
        if name:
            self._end_tag(name.group().lower())
        elif mark == "!" and not source.startswith("[", at + 2) and source[at + 2:at + 9].lower() != "doctype":
            self.out.append(f"<!--{source[at + 2:end]}-->")
        return end + 1

    def _start_tag(self, source, name):
        attrs, at = {}, name.end()
        while True:
            found = ATTRIBUTE.match(source, at)
            at = found.end()
            if not found.group(1):
                break
            value = found.group(2) or found.group(3) or found.group(4) or ""
            attrs.setdefault(found.group(1).lower(), html.unescape(value))
        if not source.startswith(">", at):
            return len(source)
        tag = name.group().lower()
        self._element(tag, attrs)
        if tag not in RAW_END:
            return at + 1
        found = RAW_END[tag].search(source, at + 1)
        text = source[at + 1:found.start() if found else len(source)]
        if text:
            self._data(text if tag in RAW else html.unescape(text))
        self._end_tag(tag)
        return found.end() if found else len(source)

    # -- building ---------------------------------------------------------

    def _element(self, tag, attrs):
        if tag in ("html", "body") and self.open_at[tag]:
            return
        self._make_room(tag)
        el = Element(tag, attrs, self.open[-1] if self.open else None, len(self.elements))
        self.elements.append(el)
        shown = "".join(f' {n}="{html.escape(v)}"' for n, v in attrs.items())
        self.out.append(f"<{tag}{shown}>")
        el.text_at, el.out_at = len(self.texts), len(self.out)
        self.open_at[tag].append(len(self.open))
        if tag in SPECIAL:
            self.special_at.append(len(self.open))
        self.open.append(el)
        if tag in VOID:
            self._pop()

    def _end_tag(self, tag):
        at = self._last(tag)
        # A formatting element closed over an open block stays open.
        if at >= 0 and not (tag in FORMATTING and self.special_at and self.special_at[-1] > at):
            self._pop_down_to(at)

    def _data(self, data):
        self.texts.append(data)
        if self.open and self.open[-1].tag in RAW:
            self.out.append(data)
        else:
            self.out.append(html.escape(data).replace("&quot;", "&#34;").replace("&#x27;", "&#39;"))

    def _make_room(self, tag):
        if tag in BLOCKS:
            self._close_open(("p",), P_BOUNDARY)
        if tag in CLOSES:
            self._close_open(CLOSES[tag], BOUNDARY)

    def _close_open(self, kinds, boundary):
        """Close the open elements of these kinds, up to the last boundary. Of a
        single kind one is closed."""
        found = max(map(self._last, kinds))
        limit = max(map(self._last, boundary)) if found >= 0 else 0
        while found > limit:
            self._pop_down_to(found)
            found = max(map(self._last, kinds)) if len(kinds) > 1 else -1

    def _last(self, tag):
        """Place of the innermost open element with that tag, or -1."""
        at = self.open_at.get(tag)
        return at[-1] if at else -1

    def _pop_down_to(self, at):
        while len(self.open) > at:
            self._pop()

    def _pop(self):
        el = self.open.pop()
        self.open_at[el.tag].pop()
        if el.tag in SPECIAL:
            self.special_at.pop()
        el.end, el.text_end, el.out_end = len(self.elements), len(self.texts), len(self.out)
        if el.tag not in VOID:
            self.out.append(f"</{el.tag}>")

    # -- reading ----------------------------------------------------------

    def select(self, css, within=None):
        """Matches in document order, below ``within`` when given."""
        search = self.searches.get(css)
        if search is None:
            search = self.searches[css] = Search(self.elements, compile_css(css))
        return search.between(*((within.pos + 1, within.end) if within else (0, len(self.elements))))

    def first(self, css, within=None):
        return next(self.select(css, within), None)

    def text(self, el):
        return "".join(self.texts[el.text_at:el.text_end])

    def inner(self, el):
        return "".join(self.out[el.out_at:el.out_end])

    def text_without(self, css, within=None):
        """Text of the document, or of one element, outside the matched elements."""
        at, end = (within.text_at, within.text_end) if within else (0, len(self.texts))
        kept = []
        for el in self.select(css, within):
            if el.text_at >= at:
                kept += self.texts[at:el.text_at]
                at = el.text_end
        return "".join(kept + self.texts[at:end])


# -- selectors --------------------------------------------------------------

ATTR = r"""\[\s*([\w-]+)\s*(?:([*^$~|]?=)\s*(?:'([^']*)'|"([^"]*)"|([\w-]+))\s*)?\]"""
SIMPLE = re.compile(rf"\.([\w-]+)|\#([\w-]+)|{ATTR}")
COMPOUND = re.compile(r"([\w-]+|\*)?((?:\.[\w-]+|#[\w-]+|\[(?:'[^']*'|\"[^\"]*\"|[^\]'\"])*\])*)")


COMPILED = {}


def compile_css(css):
    """The groups of a selector, compiled once per worker. (A plain dictionary: a
    cache decorator would tie this module to an installed package.)"""
    if css not in COMPILED:
        COMPILED[css] = parse_css(css)
    return COMPILED[css]


def parse_css(css):
    """Comma groups, each a list of (step kind, compound) from right to left.

    A selector outside the grammar gives no group and so matches nothing.
    """
    groups, steps, i, kind, css = [], [], 0, "", css.strip()
    while i < len(css):
        m = COMPOUND.match(css, i)
        if not m.group(0):
            return ()
        tests = [(c, h, n, op, a + b + w) for c, h, n, op, a, b, w in SIMPLE.findall(m.group(2))]
        steps.append((kind, (m.group(1) or "*").lower(), tests))
        gap = re.compile(r"\s*([>,])\s*|\s+|$").match(css, m.end())
        if not gap:
            return ()
        kind, i = gap.group(1) or " ", gap.end()
        if kind == "," or i >= len(css):
            if i >= len(css) and gap.group(1):
                return ()
            groups.append(tuple(reversed(steps)))
            steps, kind = [], ""
    return tuple(groups)


def passes(el, tag, tests):
    if tag != "*" and el.tag != tag:
        return False
    for cls, ident, name, op, want in tests:
        if cls:
            ok = cls in el.classes
        elif ident:
            ok = el.attrs.get("id") == ident
        else:
            have = el.attrs.get(name.lower())
            ok = have is not None and (
                not op
                or op == "=" and have == want
                or op == "*=" and want != "" and want in have
                or op == "^=" and want != "" and have.startswith(want)
                or op == "$=" and want != "" and have.endswith(want)
                or op == "~=" and want in have.split()
                or op == "|=" and (have == want or have.startswith(want + "-")))
        if not ok:
            return False
    return True


class Search:
    """The matches of one selector in a document, found as far as they are asked for.

    Every element is tested once, in document order. ``here`` has bit j set for an
    element that fulfils step j with all steps before it above; ``above`` gathers
    that over the element and all it lies in. A step looks at its parent only.
    """

    def __init__(self, elements, groups):
        self.elements, self.found, self.done = elements, [], 0
        # The steps of all groups from left to right; a group's first has no kind.
        self.steps, self.last = [], 0
        for group in groups:
            self.steps += reversed(group)
            self.last |= 1 << (len(self.steps) - 1)
        self.here, self.above = [], []

    def between(self, lo, hi):
        while self.done < lo:
            self._test()
        at = bisect_left(self.found, lo)
        while True:
            while at == len(self.found) and self.done < hi:
                self._test()
            if at == len(self.found) or self.found[at] >= hi:
                return
            yield self.elements[self.found[at]]
            at += 1

    def _test(self):
        el = self.elements[self.done]
        inner, outer = (self.here[el.parent.pos], self.above[el.parent.pos]) if el.parent else (0, 0)
        here = 0
        for j, (kind, tag, tests) in enumerate(self.steps):
            before = inner if kind == ">" else outer
            if (not kind or before >> (j - 1) & 1) and passes(el, tag, tests):
                here |= 1 << j
        self.here.append(here)
        self.above.append(outer | here)
        if here & self.last:
            self.found.append(self.done)
        self.done += 1

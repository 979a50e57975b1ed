"""Page -> candidate values. One Arrow job per page shape; no shuffle."""

from __future__ import annotations

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidings import schema
from tidings.functions import text as tx
from tidings.operators import dom
from tidings.session import page_batches

# The helper travels inside the function, so workers need no installed package.
cloudpickle.register_pickle_by_value(dom)

# Rules travel with the function; more of them than this is a mistake, not data.
MAX_RULES = 200_000

# Where detail pages keep their parts, and what is never text.
OG_TITLE, OG_IMAGE = "meta[property='og:title']", "meta[property='og:image']"
BODY_IMAGE = "article img, .post-content img, .entry-content img"
BODIES = ("article", ".post-content, .entry-content, .content", "main")
NOT_TEXT = "script, style, nav, footer, .ads, [class*='advertisement']"


def compile_rules(rules: DataFrame) -> dict[str, dict[str, list[tuple[str, str | None]]]]:
    """Rules as plain values for the tasks: language -> field -> (css, attr).

    Two defaults are settled here: a next-page rule without attribute reads
    ``href``; an image rule without one takes the attribute of the rule before
    it, at first ``src``. A rule with more than one ``@`` matches nothing.
    """
    rows = rules.limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} extraction rules")
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.field, r.priority)):
        out.setdefault(r.lang, {}).setdefault(r.field, []).append((r.css, r.attr))
    for fields in out.values():
        fields["next"] = [(css, "href" if attr is None else attr)
                          for css, attr in fields.get("next", ())]
        attr = "src"
        for i, (css, own) in enumerate(fields.get("image", ())):
            attr = attr if own is None else own
            fields["image"][i] = (css, attr)
    return out


def once(returns):
    """An Arrow function that is evaluated once per row.

    Marked as not deterministic, so that the optimizer neither repeats it where
    its result is used twice nor copies it into a pushed-down filter.
    """
    return lambda fn: F.arrow_udf(fn, returns).asNondeterministic()


def listing_udf(compiled: dict):
    """(html, lang) -> next link and raw cards, in document order."""
    out_type = to_arrow_type(schema.LISTING)
    white = tx.WHITE_SPACE

    def first_value(doc, rules, within=None):
        """Value and attribute of the first rule that gives something."""
        for css, attr in rules:
            el = doc.first(css, within)
            if el is not None:
                value = doc.text(el).strip(white) if attr is None else el.attrs.get(attr, "")
                if value:
                    return value, attr
        return "", None

    def card(doc, el, rules):
        def value(field):
            return first_value(doc, rules.get(field, ()), el)
        title, url, text, date = (value(f)[0] for f in ("title", "url", "text", "date"))
        image, attr = value("image")
        incomplete = "" in (title, url, image, text, date)
        return {"title": title, "url": url, "image": image, "image_attr": attr, "text": text,
                "date_raw": date, "html": doc.inner(el) if incomplete else None}

    def page(source, lang):
        rules = compiled.get(lang)
        if source is None or rules is None:
            return {"next_link": "", "cards": []}
        doc = dom.Document(source)
        found = doc.select(rules["card"][0][0]) if rules.get("card") else ()
        return {"next_link": first_value(doc, rules["next"])[0],
                "cards": [card(doc, el, rules) for el in found]}

    @once(schema.LISTING)
    def extract(sources: pa.Array, langs: pa.Array) -> pa.Array:
        rows = [page(s, lang) for s, lang in zip(sources.to_pylist(), langs.to_pylist())]
        return pa.array(rows, type=out_type)

    return extract


def extract_listing(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Replace ``html`` by ``next_link`` (normalised) and the array ``cards``."""
    extract = listing_udf(compile_rules(rules))
    page_batches(pages.sparkSession)
    return (pages.withColumn("listing", extract("html", "lang")).drop("html")
            .withColumn("next_link", tx.normalize_url(F.col("listing.next_link")))
            .withColumn("cards", F.col("listing.cards")).drop("listing"))


def detail_udf(blocks: tuple[str, ...] = tx.STRIP_BLOCKS):
    """html -> title, image and body of a detail page.

    The body comes as text; only where a block to be cut may be in it does its
    markup come instead, for ``strip_blocks``.
    """
    out_type = to_arrow_type(schema.DETAIL)
    white, hidden = tx.WHITE_SPACE, NOT_TEXT
    names = [name.lower() for name in blocks]

    def attr(doc, css, name):
        el = doc.first(css)
        return el.attrs.get(name, "") if el is not None else ""

    def page(source):
        if source is None:
            return None
        doc = dom.Document(source)
        h1 = doc.first("h1")
        body = next((el for el in map(doc.first, BODIES) if el is not None), None)
        markup = doc.inner(body) if body else ""
        lower = markup.lower()
        suspect = any(name in lower for name in names)
        return {
            "title": attr(doc, OG_TITLE, "content") or (doc.text(h1).strip(white) if h1 else ""),
            "image_url": attr(doc, OG_IMAGE, "content") or attr(doc, BODY_IMAGE, "src"),
            "text": None if suspect else doc.text_without(hidden, body) if body else "",
            "body_html": markup if suspect else None,
        }

    @once(schema.DETAIL)
    def extract(sources: pa.Array) -> pa.Array:
        return pa.array([page(s) for s in sources.to_pylist()], type=out_type)

    return extract


def tree_text_udf():
    """html -> text outside hidden elements, by document tree; NULL stays NULL."""
    hidden = NOT_TEXT

    @once("string")
    def extract(sources: pa.Array) -> pa.Array:
        texts = [None if s is None else dom.Document(s).text_without(hidden)
                 for s in sources.to_pylist()]
        return pa.array(texts, type=pa.string())

    return extract


def clean_html(df: DataFrame, html: str, out: str, nbsp: bool = True, collapse: bool = True,
               tree_only: bool = False) -> DataFrame:
    """Add ``out``, the visible text of the column ``html``.

    Flat markup is handled on the JVM side; only pages for which that would not
    be exact are sent to Python (the others travel as NULL).
    """
    by_tree = tree_text_udf()
    page_batches(df.sparkSession)
    if tree_only:
        return df.withColumn(out, tx.tidy_space(by_tree(html), nbsp, collapse))
    body, flat = F.col("__body"), F.col("__flat")
    return (df.withColumn("__body", tx.drop_raw(F.col(html)))
            .withColumn("__flat", tx.is_flat(body))
            .withColumn("__tree", by_tree(F.when(~flat, F.col(html))))
            .withColumn(out, tx.tidy_space(
                F.when(flat, tx.flat_text(body)).otherwise(F.col("__tree")), nbsp, collapse))
            .drop("__body", "__flat", "__tree"))


def extract_detail(pages: DataFrame, blocks: tuple[str, ...] = tx.STRIP_BLOCKS) -> DataFrame:
    """Replace ``html`` by ``title``, ``image_url`` and the clean ``text`` of the body."""
    rows = pages.withColumn("detail", detail_udf(blocks)("html")).drop("html")
    rows = rows.withColumn("__cut", tx.strip_blocks(F.col("detail.body_html"), blocks))
    cut = clean_html(rows, "__cut", "__text", tree_only=True)
    return cut.select(
        *[c for c in rows.columns if c not in ("detail", "__cut")],
        "detail.title", "detail.image_url",
        F.coalesce(tx.tidy_space(F.col("detail.text")), "__text").alias("text"))


# --- Simple markup, without a document tree ---------------------------------


def _one(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def detail_by_pattern(pages: DataFrame, blocks: tuple[str, ...] = tx.STRIP_BLOCKS) -> DataFrame:
    """``extract_detail`` for pages with one flat ``article`` and ``h1``: no Python."""
    html = F.col("html")

    def plain(c):
        return tx.trim_space(tx.flat_text(c))

    og = [plain(_one(html, rf"""(?is)<meta\s[^>]*property=["']og:{p}["'][^>]*content="([^"]*)\""""))
          for p in ("title", "image")]
    body = _one(html, r"(?is)<article(?=[\s>])[^>]*+>(.*?)</article\s*>")
    h1 = _one(html, r"(?is)<h1(?=[\s>])[^>]*+>(.*?)</h1\s*>")
    img = _one(body, r"""(?is)<img\s[^>]*?\bsrc="([^"]*)\"""")
    return pages.select(
        *[c for c in pages.columns if c != "html"],
        tx.first_nonblank(F.array(og[0], plain(h1))).alias("title"),
        tx.first_nonblank(F.array(og[1], plain(img))).alias("image_url"),
        tx.tidy_space(tx.flat_text(tx.drop_raw(tx.strip_blocks(body, blocks)))).alias("text"),
    )


def cards_by_pattern(pages: DataFrame, card: str, fields: dict[str, str]) -> DataFrame:
    """``cards`` for simple markup: one pattern cuts the cards, one each reads a field.

    ``card`` and every field pattern have one group. Fields not given are ''.
    """
    def read(block, name):
        pattern = fields.get(name)
        return tx.trim_space(tx.flat_text(_one(block, pattern))) if pattern else F.lit("")

    def build(block):
        return F.struct(
            *[read(block, n).alias(n) for n in ("title", "url", "image")],
            F.lit("src").alias("image_attr"),
            read(block, "text").alias("text"), read(block, "date").alias("date_raw"),
            block.alias("html"))

    blocks = F.regexp_extract_all(F.col("html"), F.lit(card), F.lit(1))
    return pages.withColumn("cards", F.transform(blocks, build)).drop("html")

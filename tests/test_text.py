import html
import random
import time

from pyspark.sql import functions as F

from tidings.functions import text as tx
from tidings.operators import extract


def test_normalize_url(apply):
    given = ["http://host.test/a/b#top", "\t//host.test/ \n", " /a?b=1#c#d", "#x", "", None]
    assert apply(tx.normalize_url, given) == [
        "http://host.test/a/b", "//host.test/", "/a?b=1", "", "", None]


def test_url_host(apply):
    given = ["https://u:p@a.example:8080/x", "http://a_b.example?q", "/rel", "//cdn.example/x", "mailto:a@b"]
    assert apply(tx.url_host, given) == ["a.example:8080", "a_b.example", "", "cdn.example", ""]


def test_strip_symbols(apply):
    given = ["\U0001f600 \U0001f9ffНовость", "«Ёлка» дома", "Ү abc", "  ", "→ 5", "яЁ", "\tx"]
    assert apply(tx.strip_symbols, given) == ["Новость", "лка» дома", "abc", "", "5", "яЁ", "\tx"]


def test_strip_symbols_long_run_of_symbols(apply):
    assert apply(tx.strip_symbols, ["é" * 300_000 + "x"]) == ["x"]


def test_trim_and_tidy(apply):
    assert apply(tx.trim_space, ["   a b　\n", "​a"]) == ["a b", "​a"]
    assert apply(tx.tidy_space, ["a  b \n\t c\u0085", "x y"]) == ["a b c", "x y"]
    assert apply(lambda c: tx.tidy_space(c, nbsp=False), ["a  b  c"]) == ["a  b c"]
    assert apply(lambda c: tx.tidy_space(c, collapse=False), [" a  b "]) == ["a  b"]


def plain_preview(text, n):
    raw = text.encode()
    if len(raw) <= n:
        return text
    head = raw[:n]
    at = head.rfind(b" ")
    return (head[:at] if at > 0 else head).decode(errors="ignore") + "…"


def test_preview_sample(apply):
    text = "Мост через реку откроют весной, когда просохнет новое дорожное полотно"
    out = apply(lambda c: tx.preview(c, 50), [text])[0]
    assert len(out.encode()) <= 50 and out.endswith("…")


def test_preview_random(apply):
    rng = random.Random(1)
    texts = ["".join(rng.choices(" aяé😀", (w, 3, 3, 2, 1), k=rng.randint(0, 60)))
             for w in (0, 1, 3) for _ in range(150)]
    for n in (4, 17, 50):
        assert apply(lambda c: tx.preview(c, n), texts) == [plain_preview(t, n) for t in texts]


def test_first_nonblank_and_srcset(apply):
    split = lambda c: tx.first_nonblank(F.split(c, ","))
    assert apply(split, [",,b,c", "", " ,x"]) == ["b", "", " "]
    given = ["data:x 1x, /a.jpg 2x, /b.jpg", " /a.jpg\t320w", "data:x, data:y", ", ,"]
    assert apply(tx.pick_srcset, given) == ["/a.jpg", "/a.jpg", "data:x, data:y", ", ,"]


def block_end(page, at, tag, name):
    """Where the block with that heading that starts at ``at`` ends, or None:
    its start tag, the heading, text, and only tags up to its end tag."""
    if not page.startswith("<" + tag, at) or (at := page.find(">", at) + 1) == 0:
        return None
    if tag == "aside":
        if name not in page[at:].split("<")[0]:
            return None
    elif not page.startswith(name, at):
        while page[at:at + 1] in tuple("\t\n\f\r "):
            at += 1
        is_heading = page.startswith("<h", at) and page[at + 2:at + 3].isdigit()
        at = page.find(">", at) + 1
        if not is_heading or not page.startswith(f"{name}</h", at) or page[at + len(name) + 5:at + len(name) + 6] != ">":
            return None
        at += len(name) + 6
    at = page.find("<", at)
    while at >= 0 and page.startswith("<", at):
        if page.startswith(f"</{tag}>", at):
            return at + len(tag) + 3
        at = page.find(">", at) + 1 or -1
    return None


def plain_strip(page):
    for name in tx.STRIP_BLOCKS:
        for tag in ("div", "section", "aside"):
            out, at, low = "", 0, page.lower()
            while at < len(page):
                end = block_end(low, at, tag, name.lower())
                out, at = (out, end) if end else (out + page[at], at + 1)
            page = out
    return page


def test_strip_blocks_random(apply):
    rng = random.Random(2)
    parts = ["<div>", "<div class='x'>", "</div>", "</DIV>", "<section>", "</section>", "<aside>", "</aside>",
             "<h3>", "</h3>", "<h2 id=a>", "</h2>", "<br>", "<p>", "Похожие", "ВИДЕО", "видео ", " ", "\n", "текст"]
    pages = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    assert apply(tx.strip_blocks, pages) == [plain_strip(p) for p in pages]


def test_strip_blocks_plan_is_linear_in_the_names(spark):
    rows = spark.createDataFrame([("<div>N3 x</div>y",)], "html string")
    size = {}
    for n in (1, 5, 20):
        out = rows.select(tx.strip_blocks(F.col("html"), tuple(f"N{i}" for i in range(n))).alias("html"))
        size[n] = out._jdf.queryExecution().analyzed().toString().count("regexp_replace")
        assert out.first()["html"] == ("y" if n > 3 else "<div>N3 x</div>y")
    assert size == {1: 3, 5: 15, 20: 60}


def test_strip_blocks_long_text_ends_quickly(apply):
    hostile = "<aside>" + "Видео " * 20_000 + "<br>" * 20_000 + "<div>Похожие" + "<i>" * 50_000
    assert apply(tx.strip_blocks, [hostile]) == [hostile]


def test_clean_html_sample(spark):
    source = """
        <main><h1>Рынок&nbsp;&nbsp;переехал</h1>
          <style>h1 { color: red }</style><script>var n = 1 < 2;</script>
          <div>на   новое
            место</div></main>
    """
    rows = spark.createDataFrame([(source,)], "html string")
    for tree_only in (False, True):
        out = extract.clean_html(rows, "html", "text", tree_only=tree_only).first()["text"]
        assert out == "Рынок переехал на новое место"


def test_references_with_and_without_semicolon(apply):
    given = ["a &amp; b", "and&amp", "&amp;lt;", "&amp;amp", "&lt&gt;x", "&copy2024", "&hellip", "&#39;&apos;"]
    assert apply(tx.decode_references, given) == [html.unescape(t) for t in given[:6]] + ["&hellip", "''"]


PIECES = ["<p>", "</p>", "<div class='ads'>", "<div class=\"x\">", "</div>", "<nav>", "</nav>", "<footer>",
          "</footer>", "<script>", "</script>", "var a='</p>'", "<!--", "-->", "<style>", "</style>", "a", " b ",
          "<!-->", "--!>", "&amp;", "&lt;", "&eacute;", "&", "& ", "<", "< ", ">", "<br/>", "<img alt='>'>", "<a href='?x&y=1'>",
          "</a>", "<b>", "</b>", "<title>", "</title>", "\r\n", " ", "<section class=\"big advertisement\">",
          "</section>", "<NAV id=1>", "&#39;", "&copy;"]


def test_flat_text_is_the_tree_text_wherever_it_is_used(spark):
    rng = random.Random(3)
    pages = [("".join(rng.choices(PIECES, k=rng.randint(1, 12))),) for _ in range(5000)]
    rows = spark.createDataFrame(pages, "html string")
    both = extract.clean_html(rows, "html", "mixed")
    both = extract.clean_html(both, "html", "tree", tree_only=True)
    flat = both.withColumn("flat", tx.is_flat(tx.drop_raw(F.col("html"))))
    assert flat.where("flat").count() > 300
    different = flat.where("mixed <> tree").select("html", "mixed", "tree").collect()
    assert [tuple(r) for r in different] == []


def test_clean_html_keeps_null(spark):
    rows = spark.createDataFrame([(None,)], "html string")
    assert extract.clean_html(rows, "html", "text").first()["text"] is None


def test_clean_html_takes_time_with_the_length(spark):
    """Pages of 2 MB full of openings that never close: both ways end soon."""
    pieces = ["<!--x", "<nav>", "<footer ", "<script>", "<title>", "<a ", "</a", "<p class=", "<title ", "< ",
              "<p title=x>t</p>", "<b class='" + "class=" * 50 + "'>"]
    rows = spark.createDataFrame([(p * (2_000_000 // len(p)),) for p in pieces], "html string").repartition(4).cache()
    rows.count()
    body = tx.drop_raw(F.col("html"))
    start = time.monotonic()
    rows.select(F.length(tx.flat_text(body)), tx.is_flat(body)).write.format("noop").mode("overwrite").save()
    assert time.monotonic() - start < 60
    extract.clean_html(rows, "html", "text").write.format("noop").mode("overwrite").save()
    assert time.monotonic() - start < 180
    rows.unpersist()


def test_open_hidden_elements_hide_the_rest(apply):
    assert apply(tx.flat_text, ["a<nav>b<p>c", "a<nav b", "a<nav>b</nav>c<footer>d</footer >e"]) == ["a", "a", "ace"]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.site import card, page
from tidings import session
from tidings.operators import cards as cd
from tidings.operators import extract
from tidings.sources import rules as rl


def listing(spark, html, lang="ru", rules=rl.SITE_RULES):
    rows = spark.createDataFrame([(lang, html)], "lang string, html string")
    return extract.extract_listing(rows, rl.rules_frame(spark, {"ru": rules, "kg": rules}))


def test_listing_with_the_site_rules(spark):
    html = page(
        card("/1#top", "\U0001f4f0 Первая", "сегодня", "Текст 1"),
        card("/2", None, image="/2.jpg"),
        card(None, "Без ссылки"),
        card("/4", "Без текста", text=None, image=None),
        card("/5", "«»", text=" "),
        card("/6", "Без даты", date=None),
        card("/7", "Седьмая", "вчера"),
        next_url="https://x.example/2#p")
    rows = listing(spark, html)
    assert rows.first()["next_link"] == "https://x.example/2"
    judged = cd.judge(rows, F.col("lang"), "2024-12-31")
    accepted = cd.accepted_cards(judged, "lang").orderBy("pos").collect()
    assert [(r.pos, r.seq, r.title, r.url, r.thumbnail_url, r.text, r.dt) for r in accepted] == [
        (1, 1, "Первая", "/1", "/i.jpg", "Текст 1", dt.date(2024, 12, 31)),
        (4, 5, "Без текста", "/4", "", "Без текста", dt.date(2024, 10, 18)),
        (7, 9, "Седьмая", "/7", "/i.jpg", "Текст", dt.date(2024, 12, 30)),
    ]
    issues = cd.card_issues(judged, "lang").orderBy("pos", "reason").collect()
    assert [(r.pos, r.seq, r.reason, r.stored) for r in issues] == [
        (2, 3, "no_title", False), (3, 4, "no_url", False), (4, 5, "no_thumb", True),
        (5, 7, "no_text_title", False), (6, 8, "no_date", False)]
    assert "elementor-post__title" in issues[1]["html"]


def test_rules_of_another_language_and_none(spark):
    assert listing(spark, page(card()), "kg").select(F.size("cards")).first()[0] == 1
    assert listing(spark, page(card()), "xx").select(F.size("cards")).first()[0] == 0
    assert listing(spark, None).select(F.size("cards")).first()[0] == 0


def test_rule_grammar(spark):
    rules = dict(rl.SITE_RULES, card_selectors="li", title_selectors=["a@b@c", "i", "a"], url_selectors=["a@href"],
                 image_selectors=["img@data-x", "img.none", "img"], next_page_link=["b@x@y", "a.none", "i.n"])
    html = "<ul><li><a href=' u '>t</a><img data-x=''><img class=k data-x=v src=s></ul><i class=n href=/n>"
    row = listing(spark, html, rules=rules).select("next_link", F.inline("cards")).first()
    # The attribute of the first image rule holds for those after it, and only
    # the first match of a rule is looked at.
    assert (row.title, row.url, row.image, row.next_link) == ("t", " u ", "", "/n")


def test_srcset_rule(spark):
    html = ('<article class="elementor-post"><div class="elementor-post__thumbnail">'
            '<img srcset="data:a 1x, /big.jpg 2x" src="/small.jpg"></div></article>')
    row = listing(spark, html).select(F.inline("cards")).first()
    assert (row.image, row.image_attr) == ("data:a 1x, /big.jpg 2x", "srcset")


DETAIL = """<html><head><meta property="og:title" content="OG &amp; title"><meta property='og:image' content='/og.jpg'>
</head><body><h1> <b>H</b>1 </h1><article><p>Текст&nbsp;статьи</p><img src="/in.jpg">
<div class="rel"><h3>ПОХОЖИЕ</h3> ещё<br></div><div class="top ads"><div>купи</div></div>
<script>x</script></article><main>m</main></body></html>"""


@pytest.mark.parametrize("html, want", [
    (DETAIL, ("OG & title", "/og.jpg", "Текст статьи")),
    (DETAIL.replace("og:", "no:"), ("H1", "/in.jpg", "Текст статьи")),
    ("<h1>t</h1><div class='entry-content'>a<i> b</i><img></div>", ("t", "", "a b")),
    ("<h1>t</h1><main>a<nav>n</nav><p>Видео</p></main>", ("t", "", "aВидео")),
    ("<p>nothing", ("", "", "")),
])
def test_detail_page(spark, html, want):
    rows = spark.createDataFrame([(1, html)], "id int, html string")
    row = extract.extract_detail(rows).first()
    assert (row.title, row.image_url, row.text) == want


def test_detail_by_pattern_agrees_on_flat_pages(spark):
    html = '<h1>a &amp; b</h1><article><p>x</p> <b>y</b><img alt="" src="/i.jpg"></article>'
    rows = spark.createDataFrame([(html,)], "html string")
    both = [tuple(f(rows).first()) for f in (extract.extract_detail, extract.detail_by_pattern)]
    assert both[0] == both[1] == ("a & b", "/i.jpg", "x y")


def test_one_python_step_and_no_shuffle(spark):
    rows = spark.createDataFrame([("ru", page(card()))], "lang string, html string")
    judged = cd.judge(extract.extract_listing(rows, rl.rules_frame(spark, {"ru": rl.SITE_RULES})),
                      F.col("lang"), "2024-12-31")
    plan = cd.accepted_cards(judged, "lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


@pytest.mark.parametrize("make", [lambda: extract.listing_udf({}), extract.detail_udf, extract.tree_text_udf])
def test_functions_travel_without_the_package(make):
    """Workers of a cluster need not have the package installed."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    data = cloudpickle.dumps(make().func)
    code = "import sys, pickle; sys.path = [p for p in sys.path if p]; pickle.load(sys.stdin.buffer)"
    done = subprocess.run([sys.executable, "-c", code], input=data, cwd="/", capture_output=True)
    assert done.returncode == 0, done.stderr.decode()


def test_batches_of_pages_are_bounded_by_bytes(spark):
    """Pages of 100 KB went to Python in batches of 64 MB."""
    import pyarrow as pa

    spark.conf.unset(session.BATCH_BYTES)
    rows = spark.range(0, 200, 1, 1).select(F.lit("ru").alias("lang"), F.repeat(F.lit("x"), 100_000).alias("html"))
    size = extract.once("long")(lambda pages: pa.array([len(pages) * 100_000] * len(pages), pa.int64()))
    extract.extract_listing(rows, rl.rules_frame(spark, {"ru": rl.SITE_RULES}))
    assert rows.select(size("html").alias("n")).agg(F.max("n")).first()[0] <= 2 * session.PAGE_BATCH
    for given, kept in (("1m", "1m"), ("64MB", str(session.PAGE_BATCH)), ("1000", "1000")):
        spark.conf.set(session.BATCH_BYTES, given)
        extract.extract_detail(rows)
        assert spark.conf.get(session.BATCH_BYTES) == kept
    spark.conf.unset(session.BATCH_BYTES)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.site import card, page
from tidings import schema
from tidings.operators import cards as cd
from tidings.operators import extract, lookup
from tidings.plans.run import run_news
from tidings.sources import pages as page_source
from tidings.sources import rules as rl
from tidings.sources import sinks
from tidings.streaming import ingest

RUN = "2024-12-31"
BASE = "https://x.example"


@pytest.fixture(scope="module")
def rules(spark):
    return rl.rules_frame(spark, {"ru": rl.SITE_RULES, "kg": rl.SITE_RULES})


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(1, "ru"), (2, "ky")], schema.LANG_DIM)


@pytest.fixture(scope="module")
def languages(spark):
    return spark.createDataFrame(
        [("ru", 1, f"{BASE}/ru", 5), ("kg", 2, f"{BASE}/kg", 2), ("xx", 3, f"{BASE}/none", 5)], schema.LANGUAGES)


def fetched(spark, pages, at="2024-12-31 06:00:00"):
    rows = [(url, lang, None, 200, html, None, dt.datetime.fromisoformat(at)) for url, lang, html in pages]
    return spark.createDataFrame(rows, schema.PAGES)


def site():
    old = [card(f"/old{i}", f"Старая {i}", "1 мая 2024") for i in range(3)]
    return [
        (f"{BASE}/ru", "ru", page(card("/a", "А", "сегодня"), card("/b", "Б", "вчера"), card("/bad", None),
                                  card("/old", "О", "1 мая 2024"), next_url=f"{BASE}/ru2#x")),
        (f"{BASE}/ru2", "ru", page(*old, next_url=f"{BASE}/ru3")),
        (f"{BASE}/ru3", "ru", page(*old, next_url=f"{BASE}/ru4")),
        (f"{BASE}/ru4", "ru", page(card("/late", "Л", "сегодня"))),
        (f"{BASE}/kg", "kg", page(card("/a", "Башка", "бүгүн"), card("/k", "К", "7 декабрь 2024"), card("/u", "У", "жок"),
                                  next_url=f"{BASE}/kg2")),
        (f"{BASE}/kg2", "kg", page(card("/k2", "К2", "30.12.2024", image=None), next_url=f"{BASE}/kg3")),
        (f"{BASE}/kg3", "kg", page(card("/k3", "К3", "бүгүн"))),
    ]


def run(spark, pages, rules, languages, dim, news, **kw):
    return run_news(pages, rules, languages, dim, news, RUN, days_back=120, stop_after=2, **kw)


def test_a_run_and_the_same_run_again(spark, rules, languages, dim, tmp_path):
    table = sinks.NewsTable(spark, str(tmp_path / "news"))
    # An older fetch of the first page must not count.
    pages = fetched(spark, site()).unionByName(
        fetched(spark, [(f"{BASE}/ru", "ru", page(card("/stale", "С", "сегодня")))], "2024-12-30 06:00:00"))
    first = run(spark, pages, rules, languages, dim, table.read())
    stats = sorted(tuple(r) for r in first.stats.collect())
    assert stats == [("kg", 2, 4, 0, 0, "max_pages"), ("ru", 3, 9, 7, 2, "old_streak"), ("xx", 0, 0, 0, 0, "fetch_error")]
    rows = {r.url: r for r in first.merged.collect()}
    assert set(rows) == {"/a", "/b", "/k", "/k2"}
    # '/a' came first in Russian and last in Kyrgyz: last values, first language.
    assert (rows["/a"].language_uid, rows["/a"].title, rows["/a"].dt) == (1, "Башка", dt.date(2024, 12, 31))
    assert rows["/b"].sequence_num == 3 and len(rows["/b"].check_sum) == 320
    assert {r.status for r in rows.values()} == {"new"}
    issues = sorted((r.lang, r.page_num, r.reason, r.stored) for r in first.issues.collect())
    assert issues == [("kg", 2, "no_thumb", True), ("ru", 1, "no_title", False)]
    assert first.unknown.isEmpty()

    table.write(first.merged)
    again = run(spark, pages, rules, languages, dim, table.read())
    # The marks are inclusive: cards of the newest day of a language are merged again.
    assert {r.url: r.status for r in again.merged.collect()} == {
        "/a": "unchanged", "/b": "kept", "/k": "kept", "/k2": "unchanged"}


def test_a_run_ends_where_pages_link_back(spark, rules, dim, tmp_path):
    languages = spark.createDataFrame([("ru", 1, f"{BASE}/1", 10**9)], schema.LANGUAGES)
    pages = [(f"{BASE}/1", "ru", page(card("/a", "А", "сегодня"), next_url=f"{BASE}/2")),
             (f"{BASE}/2", "ru", page(card("/b", "Б", "вчера"), next_url=f"{BASE}/1#top"))]
    out = run(spark, fetched(spark, pages), rules, languages, dim, sinks.NewsTable(spark, str(tmp_path / "n")).read())
    assert [tuple(r) for r in out.stats.collect()] == [("ru", 2, 2, 0, 0, "loop")]
    assert sorted(r.url for r in out.merged.collect()) == ["/a", "/b"]


def test_unknown_language_is_reported_not_stored(spark, rules, languages, tmp_path):
    only_ru = spark.createDataFrame([(1, "ru")], schema.LANG_DIM)
    news = sinks.NewsTable(spark, str(tmp_path / "n")).read()
    out = run(spark, fetched(spark, site()), rules, languages, only_ru, news)
    assert {r.url for r in out.merged.collect()} == {"/a", "/b"}
    assert {(r.lang, r.url) for r in out.unknown.collect()} == {("kg", "/a"), ("kg", "/k"), ("kg", "/k2")}


def test_no_card_vanishes(spark, rules, languages, tmp_path):
    only_ru = spark.createDataFrame([(1, "ru")], schema.LANG_DIM)
    out = run(spark, fetched(spark, site()), rules, languages, only_ru, sinks.NewsTable(spark, str(tmp_path / "n")).read())
    assert sorted((r.lang, r.page_num, r.reason, r.url, r.date_raw) for r in out.rejects.collect()) == [
        ("kg", 1, "bad_date", "/u", "жок"), ("kg", 1, "unknown_language", "/a", "бүгүн"),
        ("kg", 1, "unknown_language", "/k", "7 декабрь 2024"), ("kg", 2, "unknown_language", "/k2", "30.12.2024")]
    # Every accepted card of a visited page is stored, before the mark, or rejected.
    cards = sum(r.cards for r in out.pages.where("page_num <= 3").collect())
    old = sum(r.old for r in out.pages.where("page_num <= 3").collect())
    assert cards == old + out.batch.count() + out.rejects.count()


def articles_of(rules, dim, marks):
    def to_articles(pages):
        judged = cd.judge(extract.extract_listing(pages, rules), F.col("lang"), RUN)
        new, _ = ingest.new_and_late(cd.accepted_cards(judged, "lang", "page_num"), marks)
        return lookup.with_language_uid(cd.to_articles(new, "page_num", "pos"), dim)
    return to_articles


def test_stream_in_many_micro_batches_equals_one_batch(spark, rules, languages, dim, tmp_path):
    source = str(tmp_path / "pages")
    for n in range(6):
        cards = [card(f"/{(n * 3 + i) % 7}", f"Т{n}{i}", f"{20 + i} декабря 2024" if i else "1 мая 2024") for i in range(4)]
        (fetched(spark, [(f"{BASE}/{n}", "ru", page(*cards))]).withColumn("page_num", F.lit(n))
         .coalesce(1).write.mode("append").parquet(source))
    result = []
    for name, files in (("one", None), ("many", 1)):
        table = sinks.NewsTable(spark, str(tmp_path / name / "news"))
        marks = ingest.frozen_marks(table.read(), languages, dim, RUN, 120)
        args = (articles_of(rules, dim, marks), table, ["page_num", "pos"], str(tmp_path / name / "stage"),
                str(tmp_path / name / "ck"))
        batches = ingest.ingest(page_source.stream_pages(spark, source, files_per_batch=files), *args)
        assert batches == (6 if files else 1)
        result.append(sorted(map(tuple, table.read().collect())))
        # Nothing new arrived: nothing is staged and no snapshot is written.
        assert ingest.ingest(page_source.stream_pages(spark, source, files_per_batch=files), *args) == 0
        assert table.versions() == [1]
    assert result[0] == result[1] and len(result[0]) == 7


def test_articles_staged_by_a_run_that_died_are_merged_by_the_next(spark, rules, languages, dim, tmp_path):
    source, stage = str(tmp_path / "pages"), str(tmp_path / "stage")
    table = sinks.NewsTable(spark, str(tmp_path / "news"))
    to_articles = articles_of(rules, dim, ingest.frozen_marks(table.read(), languages, dim, RUN, 120))

    def arrive(n):
        (fetched(spark, [(f"{BASE}/{n}", "ru", page(card(f"/{n}", "Т", "сегодня")))])
         .withColumn("page_num", F.lit(n)).write.mode("append").parquet(source))

    arrive(1)
    stream = page_source.stream_pages(spark, source)
    ingest.stage_articles(stream, to_articles, stage, str(tmp_path / "ck")).awaitTermination()
    assert table.versions() == []
    arrive(2)
    ingest.ingest(page_source.stream_pages(spark, source), to_articles, table, ["page_num", "pos"], stage,
                  str(tmp_path / "ck"))
    assert sorted(r.url for r in table.read().collect()) == ["/1", "/2"]


def test_late_cards_of_a_stream_count_once(spark, rules, languages, dim, tmp_path):
    source, late = str(tmp_path / "pages"), str(tmp_path / "late")
    for n in range(3):
        cards = [card(f"/{n}-{i}", "Т", "1 мая 2023" if i <= n else "сегодня") for i in range(4)]
        (fetched(spark, [(f"{BASE}/{n}", "ru", page(*cards))]).withColumn("page_num", F.lit(n)).coalesce(1).write.mode("append").parquet(source))
    table = sinks.NewsTable(spark, str(tmp_path / "news"))
    marks = ingest.frozen_marks(table.summary(), languages, dim, RUN, 120)

    def to_articles(pages):
        judged = cd.judge(extract.extract_listing(pages, rules), F.col("lang"), RUN)
        new, old = ingest.new_and_late(cd.accepted_cards(judged, "lang", "page_num"), marks)
        return (lookup.with_language_uid(cd.to_articles(new, "page_num", "pos"), dim), ingest.late_per_page(old, "lang", "page_num"))

    def go(checkpoint):
        stream = page_source.stream_pages(spark, source, files_per_batch=1)
        ingest.ingest(stream, to_articles, table, ["page_num", "pos"], str(tmp_path / "stage"), str(tmp_path / checkpoint), late)
        return {(r.lang, r.page_num): r.late for r in ingest.late_counts(spark, late, "lang", "page_num").collect()}

    want = {("ru", n): n + 1 for n in range(3)}
    assert ingest.late_counts(spark, late, "lang", "page_num").collect() == []
    assert go("ck") == want and table.read().count() == 6
    # Micro-batches that are repeated replace their counts.
    assert go("again") == want and table.read().count() == 6


def test_late_cards_only_count(spark):
    cards = spark.sql("select * from values ('ru', date'2024-01-01'), ('ru', date'2024-06-01'), ('ru', null) t(lang, dt)")
    marks = spark.sql("select 'ru' lang, date'2024-06-01' mark")
    new, late = ingest.new_and_late(cards, marks)
    assert (new.count(), late.count()) == (1, 1)

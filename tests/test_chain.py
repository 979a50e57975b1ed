import pytest
from pyspark.sql import functions as F

from checks import queries
from tidings import schema
from tidings.operators import chain


@pytest.fixture(scope="module")
def links(spark):
    rows = [("a", "/1", "/2"), ("a", "/2", "/3"), ("a", "/3", ""), ("a", "/9", "/1"), ("b", "/1", "/2"),
            ("b", "/2", "/1"), ("c", "/1", "/gone")]
    return spark.createDataFrame(rows, "lang string, url string, next_link string").cache()


def walk(spark, links, langs):
    languages = spark.createDataFrame([(g, i, u, n) for i, (g, u, n) in enumerate(langs)], schema.LANGUAGES)
    rows = chain.page_chain(links, languages).collect()
    return sorted((r.lang, r.page_num, r.url, r.fetched) for r in rows)


def test_chains(spark, links):
    got = walk(spark, links, [("a", "/1", 9), ("b", "/1", 4), ("c", "/1", 5), ("d", "/1", 5), ("e", "/1", 0)])
    assert got == [
        ("a", 1, "/1", True), ("a", 2, "/2", True), ("a", 3, "/3", True),
        ("b", 1, "/1", True), ("b", 2, "/2", True), ("b", 3, "/1", True), ("b", 4, "/2", True),
        ("c", 1, "/1", True), ("c", 2, "/gone", False), ("d", 1, "/1", False)]


def test_no_language(spark, links):
    assert walk(spark, links, [("a", "/1", 0)]) == []


@pytest.mark.parametrize("limit", [1, 2, 3, 14, 16])
def test_loop_ends_at_limit(spark, links, limit):
    got = walk(spark, links, [("b", "/1", limit)])
    assert [n for _, n, _, _ in got] == list(range(1, limit + 1))


def test_a_loop_is_reported_and_not_unrolled(spark, links, monkeypatch):
    made = []
    plain = chain.written
    monkeypatch.setattr(chain, "written", lambda df, name: made.append(name) or plain(df, name))
    rows = [("a", "/1", "/2"), ("a", "/2", "/3"), ("a", "/3", "/4"), ("a", "/4", "/5"), ("a", "/5", "/3"), ("b", "/1", "/2"),
            ("b", "/2", "/1"), ("c", "/1", "/gone"), ("d", "/1", "/1"), ("e", "/1", "/2"), ("e", "/2", "")]
    links = spark.createDataFrame(rows, "lang string, url string, next_link string")
    languages = spark.createDataFrame([(g, i, "/1", 10**9) for i, g in enumerate("abcde")], schema.LANGUAGES)
    got = sorted((r.lang, r.page_num, r.url, r.fetched, r.loops) for r in chain.page_chain(links, languages, True).collect())
    assert got == [
        ("a", 1, "/1", True, False), ("a", 2, "/2", True, False), ("a", 3, "/3", True, False), ("a", 4, "/4", True, False),
        ("a", 5, "/5", True, True), ("b", 1, "/1", True, False), ("b", 2, "/2", True, True), ("c", 1, "/1", True, False),
        ("c", 2, "/gone", False, False), ("d", 1, "/1", True, True), ("e", 1, "/1", True, False), ("e", 2, "/2", True, False)]
    assert len(made) < 10


@pytest.mark.parametrize("limit", [1, 2, 3, 14])
def test_pages_of_a_loop_stop_at_the_limit_too(spark, limit):
    links = spark.range(1, 6).selectExpr("'a' as lang", "cast(id as string) as url", "cast(id % 5 + 1 as string) as next_link")
    languages = spark.createDataFrame([("a", 1, "1", limit)], schema.LANGUAGES)
    got = sorted((r.page_num, r.loops) for r in chain.page_chain(links, languages, True).collect())
    assert got == [(n, n == 5) for n in range(1, min(limit, 5) + 1)]


def test_null_link_ends_chain(spark):
    links = spark.createDataFrame([("a", "/1", "/2"), ("a", "/2", None)], "lang string, url string, next_link string")
    assert walk(spark, links, [("a", "/1", 9)]) == [("a", 1, "/1", True), ("a", 2, "/2", True)]


def test_rounds_grow_with_logarithm(spark, monkeypatch):
    """Sixteen times the pages: four more rounds of two tables each."""
    made = []
    plain = chain.written
    monkeypatch.setattr(chain, "written", lambda df, name: made.append(name) or plain(df, name))

    def rounds(pages):
        made.clear()
        links = spark.range(1, pages + 1).selectExpr("'a' as lang", "cast(id as string) as url",
                                                     f"if(id < {pages}, cast(id + 1 as string), '') as next_link")
        assert [n for _, n, _, _ in walk(spark, links, [("a", "1", 10**9)])] == list(range(1, pages + 1))
        return len(made)

    assert rounds(600) - rounds(38) == 8


def test_chains_over_pages_with_repeated_urls_end(spark, tmp_path, monkeypatch):
    """A URL of two pages has the link of the newest; with both, walks would go back and multiply."""
    made = []
    plain = chain.written

    def written(df, name):
        made.append(name)
        assert len(made) < 12
        return plain(df, name)

    monkeypatch.setattr(chain, "written", written)
    urls = [f"https://a.example/{'de' if n else 'fr'}/{5 if n == 2 else n}" for n in range(8)]
    rows = [(n, url) for n, url in enumerate(urls)] + [(9, None)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.lang, r.page_num, r.url[-1], r.fetched) for r in queries.page_chain(spark, str(tmp_path)).where("lang is not null").collect())
    assert got == [
        ("de", 1, "1", True), ("de", 2, "5", True), ("de", 3, "6", True), ("de", 4, "7", True),
        ("fr", 1, "0", True), ("fr", 2, "1", True), ("fr", 3, "5", True), ("fr", 4, "6", True), ("fr", 5, "7", True), ("fr", 6, "/", False)]


def test_latest_fetch(spark):
    rows = spark.sql("""select * from values ('a', timestamp'2024-01-01 00:00:00', 'old', 1),
        ('a', timestamp'2024-01-02 00:00:00', 'new', 1), ('a', timestamp'2024-01-02 00:00:00', 'newer', 2),
        ('b', timestamp'2023-01-01 00:00:00', 'only', 1) t(url, fetched_at, html, n)""")
    out = chain.latest_fetch(rows, ["url"], "n").select("url", "html").orderBy("url").collect()
    assert [tuple(r) for r in out] == [("a", "newer"), ("b", "only")]
    assert "partial_max_by" in chain.latest_fetch(rows, ["url"], "n").select(
        F.col("html"))._jdf.queryExecution().executedPlan().toString()

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.site import card, page
from tidings.sources import pages as page_source
from tidings.sources import rules as rl
from tidings.sources import sinks
from tidings.sources.parsed import ParsedPages

DAY = "2024-12-{:02d} 06:00:00"


@pytest.fixture(scope="module")
def rules(spark):
    return rl.rules_frame(spark, {"ru": rl.SITE_RULES, "kg": rl.SITE_RULES})


def arrive(spark, path, rows):
    """(url, lang, html, day) appended to the folder of pages."""
    frame = spark.createDataFrame([(u, g, 1, 200, h, None, DAY.format(day)) for u, g, h, day in rows],
                                  "url string, lang string, page_num int, status int, html string, "
                                  "headers map<string,array<string>>, fetched_at string")
    sinks.write_fetches(frame.withColumn("fetched_at", F.col("fetched_at").cast("timestamp")), path)


def listing(parsed, rules):
    return {(r.lang, r.url): (r.next_link, [c.url for c in r.cards]) for r in parsed.listing(rules).collect()}


def test_pages_are_parsed_once(spark, rules, tmp_path):
    path, parsed = str(tmp_path / "pages"), ParsedPages(spark, str(tmp_path / "parsed"))
    arrive(spark, path, [("/1", "ru", page(card("/a"), next_url="/2"), 1), ("/2", "ru", page(card("/b")), 1), ("/1", "kg", page(card("/k")), 2)])
    read = lambda: page_source.read_pages(spark, path)
    assert parsed.parse_new(read(), rules, "one") == 3
    assert listing(parsed, rules) == {("ru", "/1"): ("/2", ["/a"]), ("ru", "/2"): ("", ["/b"]), ("kg", "/1"): ("", ["/k"])}
    # Nothing arrived: nothing is parsed, and no listing is written.
    assert parsed.parse_new(read(), rules, "two") == 0
    assert sorted(p.name for p in (tmp_path / "parsed" / "listing").iterdir()) == ["run=one"]
    # A newer fetch of one page: it alone is parsed, and it counts from now on.
    arrive(spark, path, [("/1", "ru", page(card("/c")), 3)])
    assert parsed.parse_new(read(), rules, "three") == 1
    assert parsed._read("listing", parsed.listing(rules).schema).count() == 4
    assert listing(parsed, rules)["ru", "/1"] == ("", ["/c"])
    # Another row of a known fetch is not overlooked.
    arrive(spark, path, [("/1", "kg", page(card("/k"), card("/k2")), 2)])
    assert parsed.parse_new(read(), rules, "four") == 1
    assert parsed.parse_new(read(), rules, "five") == 0


def test_only_days_with_something_new_are_read(spark, rules, tmp_path):
    path, parsed = str(tmp_path / "pages"), ParsedPages(spark, str(tmp_path / "parsed"))
    arrive(spark, path, [(f"/{i}", "ru", page(card(f"/c{i}")), 1 + i % 3) for i in range(9)])
    parsed.parse_new(page_source.read_pages(spark, path), rules, "one")
    arrive(spark, path, [("/9", "ru", page(card("/c9")), 5)])
    pages = page_source.read_pages(spark, path)
    todo = parsed.new_fetches(pages, rules)
    narrow = todo._jdf.queryExecution().executedPlan().toString()
    assert "html" not in narrow
    wanted = parsed.markup(pages, todo, 1)
    assert re.search(r"PartitionFilters: \[.*fetch_date#\d+ = 2024-12-05\)", wanted._jdf.queryExecution().executedPlan().toString())
    assert [r.url for r in wanted.collect()] == ["/9"]
    # Too many for a broadcast: the whole day, without a join.
    whole = parsed.markup(pages, todo, 1, limit=0)
    assert [r.url for r in whole.collect()] == ["/9"] and "Join" not in whole._jdf.queryExecution().executedPlan().toString()


def test_changed_rules_parse_their_language_again(spark, rules, tmp_path):
    path, parsed = str(tmp_path / "pages"), ParsedPages(spark, str(tmp_path / "parsed"))
    arrive(spark, path, [("/1", "ru", page(card("/a")), 1), ("/1", "kg", page(card("/k")), 1), ("/x", None, page(card("/x")), 1)])
    read = lambda: page_source.read_pages(spark, path)
    assert parsed.parse_new(read(), rules, "one") == 3
    changed = rl.rules_frame(spark, {"ru": rl.SITE_RULES, "kg": dict(rl.SITE_RULES, next_page_link="a.other")})
    assert parsed.parse_new(read(), changed, "two") == 1
    assert set(listing(parsed, changed)) == {("ru", "/1"), ("kg", "/1")} | {k for k in listing(parsed, changed) if k[0] is None}
    assert parsed.parse_new(read(), changed, "three") == 0


def test_a_run_that_died_before_its_ledger_parses_again(spark, rules, tmp_path):
    path, parsed = str(tmp_path / "pages"), ParsedPages(spark, str(tmp_path / "parsed"))
    arrive(spark, path, [("/1", "ru", page(card("/a")), 1)])
    pages = page_source.read_pages(spark, path)
    parsed.parse_new(pages, rules, "one")
    (tmp_path / "parsed" / "ledger" / "run=one" / "_SUCCESS").unlink()
    assert parsed.parse_new(pages, rules, "two") == 1
    assert listing(parsed, rules) == {("ru", "/1"): ("", ["/a"])}


def test_pages_without_days_and_empty_folders(spark, rules, tmp_path):
    path, parsed = str(tmp_path / "flat"), ParsedPages(spark, str(tmp_path / "parsed"))
    arrive(spark, str(tmp_path / "pages"), [("/1", "ru", page(card("/a")), 1)])
    flat = page_source.read_pages(spark, str(tmp_path / "pages")).drop("fetch_date")
    assert parsed.parse_new(flat.limit(0), rules, "none") == 0 and listing(parsed, rules) == {}
    assert parsed.parse_new(flat.withColumn("fetched_at", F.lit(None).cast("timestamp")), rules, "undated") == 1
    assert parsed.parse_new(flat, rules, "dated") == 1
    assert listing(parsed, rules) == {("ru", "/1"): ("", ["/a"])}
    assert dt.date(2024, 12, 1) in {r.fetch_date for r in page_source.read_pages(spark, str(tmp_path / "pages")).collect()}

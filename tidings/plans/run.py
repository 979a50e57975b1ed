"""A whole run: pages -> cards -> stop rule -> new articles -> merged table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.operators import cards as cd
from tidings.operators import chain, extract, lookup, merge, stops
from tidings.session import cut, sized, written

# Days looked back, all-old pages in a row that end a run.
DAYS_BACK, STOP_AFTER = 120, 10
ORDER = ["lang_ord", "page_num", "pos"]


@dataclass
class Run:
    """Results of a run. ``batch`` is materialised; the rest is lazy and cheap."""

    pages: DataFrame      # page rows with counts, streak and reason
    stats: DataFrame      # one row per language
    batch: DataFrame      # new articles, one per URL
    issues: DataFrame     # cards for the quarantine
    unknown: DataFrame    # new articles of unknown languages
    rejects: DataFrame    # accepted cards that cannot be stored, with the reason
    merged: DataFrame     # news table after the run, with status


def extract_run(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Next link and raw cards of every page, newest fetch per (lang, url).

    The markup is dropped before the shuffle. Written as a table, as chain,
    statistics, quarantine and batch all read it and parsing is the costly part.
    """
    fetched = pages.select("lang", "url", "html", "fetched_at", F.xxhash64("html").alias("tie"))
    listing = extract.extract_listing(fetched, rules)
    latest = chain.latest_fetch(listing, ["lang", "url"], "tie").drop("fetched_at", "tie")
    return written(latest, "listing")


def run_news(pages: DataFrame, rules: DataFrame, languages: DataFrame, lang_dim: DataFrame,
             news: DataFrame, run_date, days_back: int = DAYS_BACK,
             stop_after: int = STOP_AFTER, strict_dates: bool = False,
             summary: DataFrame | None = None, listing: DataFrame | None = None) -> Run:
    """``summary`` spares the marks a look at the table (``NewsTable.summary``),
    ``listing`` holds pages that are parsed already (``ParsedPages.listing``); ``pages``
    is then not read."""
    today = F.lit(str(run_date)).cast("date")
    languages = sized(languages)
    # The marks are read once and stay as they are for the whole run.
    marks = sized(lookup.high_water_marks(news if summary is None else summary, languages, lang_dim, today, days_back))

    listing = extract_run(pages, rules) if listing is None else written(listing, "listing")
    visits = written(chain.page_chain(listing, languages, stop_at_loops=True), "visits")
    judged = cd.judge(listing.drop("next_link").join(visits, ["lang", "url"]), F.col("lang"), today,
                      strict_dates)
    counted = cd.page_counts(judged.join(marks, "lang"), F.col("mark"))
    # Counted pages are needed by the stop rule, which reads few columns, and
    # again by what it lets pass.
    counted = written(counted, "counted")

    none = F.lit(0)
    page_rows = counted.select("lang", "page_num", "url", "next_link", "fetched", "loops", "cards", "old")
    missing = visits.where(~F.col("fetched")).select(
        "lang", "page_num", "url", "next_link", "fetched", "loops", none.alias("cards"), none.alias("old"))
    page_rows = page_rows.unionByName(missing).withColumn("has_next", F.col("next_link") != "")
    page_rows = cut(stops.with_reason(stops.with_streak(page_rows), stop_after))
    stop_at = sized(stops.stop_pages(page_rows))
    stats = stops.run_stats(page_rows, stop_at, languages)

    visited = stops.until_stop(counted, stop_at)
    issues = cd.card_issues(visited, "lang", "page_num")
    accepted = cd.accepted_cards(visited, "lang", "page_num", "mark")
    new, _ = cd.split_by_mark(accepted, F.col("mark"))
    homeless = lookup.unknown_languages(new, lang_dim).select(*cd.REJECT, F.lit("unknown_language").alias("reason"))
    articles = cd.to_articles(new, "page_num", "pos")
    stored = lookup.with_language_uid(articles, lang_dim).join(
        languages.select("lang", "lang_ord"), "lang")
    batch = cut(merge.dedupe_batch(stored, ORDER))
    return Run(
        pages=page_rows, stats=stats, batch=batch, issues=issues,
        unknown=lookup.unknown_languages(articles, lang_dim),
        rejects=cd.undated_cards(accepted).unionByName(homeless),
        merged=merge.merge_plan(news, batch),
    )

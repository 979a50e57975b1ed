"""Where a crawl stops: streaks of old pages, stop page, run statistics.

Input is one row per page: ``lang, page_num, cards, old, has_next`` and, where
known, ``fetched`` (false for a page that is linked but missing) and ``loops`` (true
for a page that links back to a visited one). Page numbers of a language are
1, 2, 3, ... without gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.operators import ordered

# Reasons, in the order in which they are tested on a page.
NO_CARDS, OLD_STREAK, NO_NEXT = "no_cards", "old_streak", "no_next"
LOOP, MAX_PAGES, FETCH_ERROR = "loop", "max_pages", "fetch_error"


def count_pages(cards: DataFrame, mark: Column) -> DataFrame:
    """Page counts from card rows (``lang, page_num, dt``)."""
    return cards.groupBy("lang", "page_num").agg(
        F.count(F.lit(1)).alias("cards"),
        F.count_if(F.coalesce(F.col("dt") < mark, F.lit(False))).alias("old"),
    )


def all_old() -> Column:
    return (F.col("cards") > 0) & (F.col("old") == F.col("cards"))


def with_streak(pages: DataFrame, block: int = ordered.BLOCK) -> DataFrame:
    """Add ``streak``: all-old pages in a row up to this one.

    It is the distance to the last page that was not all old, which is a
    running maximum and so works for languages of any length.
    """
    fresh = F.when(~all_old(), F.col("page_num"))
    return (ordered.running_max(pages, ["lang"], "page_num", fresh, "__fresh", block)
            .withColumn("streak", F.col("page_num") - F.coalesce("__fresh", F.lit(0)))
            .drop("__fresh"))


def with_reason(pages: DataFrame, stop_after: int) -> DataFrame:
    """Add ``reason``: why the crawl would end on this page, NULL if it goes on."""
    return pages.withColumn("reason", (
        F.when(~fetched(pages), FETCH_ERROR)
        .when(F.col("cards") == 0, NO_CARDS)
        .when(F.col("streak") >= stop_after, OLD_STREAK)
        .when(~F.col("has_next"), NO_NEXT)
        .when(F.col("loops") if "loops" in pages.columns else F.lit(False), LOOP)))


def fetched(pages: DataFrame) -> Column:
    return F.col("fetched") if "fetched" in pages.columns else F.lit(True)


def stop_pages(pages: DataFrame) -> DataFrame:
    """First page with a reason per language: ``lang, stop_page, reason``.

    One row per language. Pass the result through ``session.sized`` before it
    is joined to many rows.
    """
    stops = pages.where(F.col("reason").isNotNull())
    return stops.groupBy("lang").agg(
        F.min("page_num").alias("stop_page"), F.min_by("reason", "page_num").alias("reason"))


def until_stop(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """Rows (pages or cards) up to their language's stop page."""
    limit = stops.select("lang", "stop_page")
    return (rows.join(limit, "lang", "left")
            .where(F.col("stop_page").isNull() | (F.col("page_num") <= F.col("stop_page")))
            .drop("stop_page"))


def run_stats(pages: DataFrame, stops: DataFrame, languages: DataFrame) -> DataFrame:
    """One row per language over the pages up to its stop page.

    The empty or missing page that ends a run is not counted.
    """
    totals = (until_stop(pages, stops).where(F.col("cards") > 0).groupBy("lang").agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.sum("cards").alias("total_cards"),
        F.sum("old").alias("old_cards"),
        F.max_by("streak", "page_num").alias("consecutive_old_pages"),
        F.max("page_num").alias("__last")))
    counts = ["total_pages", "total_cards", "old_cards", "consecutive_old_pages"]
    return (languages.select("lang", "max_pages")
            .join(totals, "lang", "left").join(stops, "lang", "left").select(
                "lang",
                *[F.coalesce(F.col(n).cast("long"), F.lit(0)).alias(n) for n in counts],
                F.coalesce("reason", F.when(F.col("__last") >= F.col("max_pages"), MAX_PAGES))
                .alias("stopped_reason")))

"""Language codes, latest dates, counts and URL lookups against the news table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions.dates import KYRGYZ, calendar_day
from tidings.session import sized


def known_codes(lang_dim: DataFrame) -> DataFrame:
    """``lang, language_uid``; the two codes of Kyrgyz stand for each other."""
    dim = lang_dim.select(F.col("alias").alias("lang"), F.col("uid").alias("language_uid"))
    other = F.create_map(*[F.lit(x) for pair in (KYRGYZ, KYRGYZ[::-1]) for x in pair])
    twins = (dim.where(F.col("lang").isin(*KYRGYZ))
             .select(other[F.col("lang")].alias("lang"), "language_uid")
             .join(dim.select("lang"), "lang", "left_anti"))
    return dim.unionByName(twins)


def with_language_uid(rows: DataFrame, lang_dim: DataFrame) -> DataFrame:
    """Rows of known languages, with ``language_uid``."""
    return rows.join(sized(known_codes(lang_dim)), "lang")


def unknown_languages(rows: DataFrame, lang_dim: DataFrame) -> DataFrame:
    """Rows whose language code is not known."""
    return rows.join(sized(known_codes(lang_dim).select("lang")), "lang", "left_anti")


def a_year_before(day: Column) -> Column:
    """Same month and day one year earlier; 29 February rolls to 1 March."""
    return calendar_day(F.year(day) - 1, F.month(day), F.day(day))


def by_language(news: DataFrame) -> DataFrame:
    """``language_uid, n, newest`` of a news table, or of the rows of its
    manifest, which hold these numbers already."""
    summed = "newest" in news.columns
    return news.groupBy("language_uid").agg(
        (F.sum("n") if summed else F.count(F.lit(1))).alias("n"), F.max("newest" if summed else "dt").alias("newest"))


def latest_dates(news: DataFrame, languages: DataFrame, lang_dim: DataFrame,
                 run_date: Column) -> DataFrame:
    """``lang, latest``: newest stored date, a year ago where nothing is stored,
    NULL where the language code is unknown. ``news`` may be the summary of a table."""
    newest = by_language(news).drop("n")
    return (languages.select("lang").join(known_codes(lang_dim), "lang", "left")
            .join(newest, "language_uid", "left")
            .select("lang", F.when(F.col("language_uid").isNotNull(),
                                   F.coalesce("newest", a_year_before(run_date))).alias("latest")))


def high_water_marks(news: DataFrame, languages: DataFrame, lang_dim: DataFrame,
                     run_date: Column, days_back: int) -> DataFrame:
    """``lang, mark``: the later of the days-back floor and the newest stored date."""
    dates = latest_dates(news, languages, lang_dim, run_date)
    return dates.select("lang", F.greatest(F.date_sub(run_date, days_back), "latest").alias("mark"))


def card_counts(news: DataFrame, languages: DataFrame, lang_dim: DataFrame) -> DataFrame:
    """``lang, n`` stored cards per known language, zero included. ``news`` may
    be the summary of a table."""
    counts = by_language(news).drop("newest")
    return (languages.select("lang").join(known_codes(lang_dim), "lang")
            .join(counts, "language_uid", "left")
            .select("lang", F.coalesce("n", F.lit(0)).alias("n")))


def url_counts(news: DataFrame) -> DataFrame:
    return news.groupBy("url").agg(F.count(F.lit(1)).alias("n"))


def known_urls(urls: DataFrame, news: DataFrame) -> DataFrame:
    """``url, known`` for every distinct URL asked for.

    Both sides are reduced to one row per URL first, so a URL that is asked for
    or stored very often meets the join as a single row.
    """
    asked = urls.select("url").distinct()
    return (asked.join(url_counts(news), "url", "left")
            .select("url", (F.coalesce("n", F.lit(0)) > 0).alias("known")))


def stored_urls(urls: DataFrame, news: DataFrame) -> DataFrame:
    """Distinct asked URLs that are stored."""
    return urls.select("url").distinct().join(news.select("url"), "url", "left_semi")


def unseen_urls(urls: DataFrame, news: DataFrame) -> DataFrame:
    """Distinct asked URLs that are not stored."""
    return urls.select("url").distinct().join(news.select("url"), "url", "left_anti")

"""Tables the checks derive from the driver's tables, alike in Spark and SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings import schema
from tidings.functions import checksum, dates
from tidings.functions import text as tx
from tidings.operators import lookup, merge, ordered, stops
from tidings.session import cut, local_table, sized
from tidings.sources import pages as page_source

RUN_DATE = "2024-12-31"
DAYS_BACK, STOP_AFTER = 120, 3
# Page limits: one that ends no chain, and one for the limit as a feature.
UNBOUND, MAX_PAGES = 1_000_000_000, 12
LANGS = ["de", "en", "es", "fr"]
# The languages the news table knows; 'fr' is left out on purpose.
UIDS = [(1, "de"), (2, "en"), (3, "es")]
# Date up to which each language was loaded before the run.
LOADED = {"de": "2024-12-15", "en": "2024-12-01", "es": "2024-08-01", "fr": "2024-12-20"}


def run_day() -> Column:
    return F.lit(RUN_DATE).cast("date")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return page_source.spread(table(spark, sf, "pages"))


def lang_dim(spark: SparkSession) -> DataFrame:
    return local_table(spark, UIDS, schema.LANG_DIM)


def languages(spark: SparkSession, max_pages: int = UNBOUND) -> DataFrame:
    rows = [(g, i + 1, f"https://example.org/{g}/1", max_pages) for i, g in enumerate(LANGS)]
    return local_table(spark, rows, schema.LANGUAGES)


def cards(spark: SparkSession, sf: str) -> DataFrame:
    """Listing cards made of documents: ten to a page, newest first."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    rn = F.col("rn") - 1
    day = F.date_sub(run_day(), (F.floor(F.col("doc_id") / 5) % 36500).cast("int"))
    return ordered.row_number(docs, ["lang"], "doc_id", "rn").select(
        "doc_id", "lang",
        F.array_position(F.array(*map(F.lit, LANGS)), F.col("lang")).cast("int").alias("lang_ord"),
        (F.floor(rn / 10) + 1).cast("int").alias("page_num"),
        (rn % 10 + 1).cast("int").alias("pos"),
        (rn % 10 * 2 + 1).cast("int").alias("seq"),
        F.concat(F.lit("https://example.org/a/"), F.floor(F.col("doc_id") / 3)).alias("url"),
        tx.trim_space(F.substring_index("text", ".", 1)).alias("title"),
        "text",
        F.lit("").alias("thumbnail_url"),
        F.when(F.col("doc_id") % 97 != 0, day).alias("dt"),
    )


def articles(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.select(
        "lang", "lang_ord", "page_num", "pos", "dt", "title", "text", "url", "thumbnail_url",
        c("seq").alias("sequence_num"),
        checksum.content_checksum(c("seq"), c("dt"), c("title"), c("text")).alias("check_sum"))


def known(spark: SparkSession, sf: str) -> DataFrame:
    """The news table before the run."""
    loaded = F.create_map(*[F.lit(x) for pair in LOADED.items() for x in pair])
    rows = cards(spark, sf).where(F.col("dt") <= loaded[F.col("lang")].cast("date"))
    return merge.dedupe_batch(
        lookup.with_language_uid(articles(rows), lang_dim(spark)), ["lang_ord", "page_num", "pos"])


def marks(spark: SparkSession, news: DataFrame) -> DataFrame:
    return sized(lookup.high_water_marks(
        news, languages(spark), lang_dim(spark), run_day(), DAYS_BACK))


def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Page counts of the cards; the last page of a language has no next link."""
    counted = cut(stops.count_pages(
        cards(spark, sf).select("lang", "page_num", "dt").join(marks(spark, known(spark, sf)), "lang"),
        F.col("mark")))
    last = sized(counted.groupBy("lang").agg(F.max("page_num").alias("last")))
    return counted.join(last, "lang").select(
        "lang", "page_num", "cards", "old", (F.col("page_num") < F.col("last")).alias("has_next"))


# --- A news site made of the documents --------------------------------------

# English documents are shown as a Russian listing, German ones as a Kyrgyz one.
SITE_LANGS = {"en": "ru", "de": "kg", "es": "es", "fr": "fr"}
SITE_UIDS = [(1, "ru"), (2, "ky")]


def site_languages(spark: SparkSession, max_pages: int = UNBOUND) -> DataFrame:
    rows = [(SITE_LANGS[g], i + 1, f"https://example.org/{SITE_LANGS[g]}/1", max_pages)
            for i, g in enumerate(LANGS)]
    return local_table(spark, rows, schema.LANGUAGES)


def site_lang_dim(spark: SparkSession) -> DataFrame:
    return local_table(spark, SITE_UIDS, schema.LANG_DIM)


def site_cards(spark: SparkSession, sf: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in SITE_LANGS.items() for x in pair])
    return cards(spark, sf).withColumn("lang", names[F.col("lang")])


def _escaped(c: Column) -> Column:
    for raw, shown in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def date_words(day: Column, months: tuple[str, ...]) -> Column:
    return F.concat_ws(" ", F.day(day), F.get(F.array(*map(F.lit, months)), F.month(day) - 1),
                       F.year(day))


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Listing pages in the site's markup, each with at most ten cards."""
    rows = site_cards(spark, sf)
    c = F.col
    shown = (F.when(c("dt").isNull(), "n/a")
             .when(c("lang") == "ru", F.concat(F.lit("Вторник, "), date_words(c("dt"), dates.RU_MONTHS)))
             .when(c("lang") == "kg", date_words(c("dt"), dates.KY_MONTHS))
             .otherwise(F.date_format("dt", "d.M.yyyy")))
    # Some cards lack a picture, a link or a date.
    image = F.when(c("doc_id") % 13 != 0, F.concat(
        F.lit('<img srcset="data:x, '), c("url"), F.lit('.jpg 2x">'))).otherwise(F.lit(""))
    href = F.when(c("doc_id") % 17 != 0, F.concat(
        F.lit(' href=" '), c("url"), F.lit('#top"'))).otherwise(F.lit(""))
    date = F.when(c("doc_id") % 194 != 0, F.concat(
        F.lit('<span class="elementor-post-date">'), shown, F.lit("</span>"))).otherwise(F.lit(""))
    card = F.concat(
        F.lit('<article class="elementor-post"><div class="elementor-post__thumbnail">'), image,
        F.lit('</div><h3 class="elementor-post__title"><a'), href, F.lit(">"), _escaped(c("title")),
        F.lit("</a></h3>"), date, F.lit('<div class="elementor-post__excerpt"><p>'),
        _escaped(c("text")), F.lit("</p></div></article>"))
    pages = rows.select("lang", "page_num", F.struct("pos", card.alias("html")).alias("card")).groupBy(
        "lang", "page_num").agg(F.array_join(F.sort_array(F.collect_list("card")).html, "\n").alias("body"))
    last = sized(rows.groupBy("lang").agg(F.max("page_num").alias("last")))
    base = F.concat(F.lit("https://example.org/"), c("lang"), F.lit("/"))
    link = F.when(c("page_num") < c("last"), F.concat(
        F.lit('<nav class="elementor-pagination"><a class="page-numbers next" href="'), base,
        c("page_num") + 1, F.lit('">next</a></nav>'))).otherwise(F.lit(""))
    return pages.join(last, "lang").select(
        F.concat(base, c("page_num")).alias("url"), "lang",
        F.concat(F.lit("<html><body>"), c("body"), link, F.lit("</body></html>")).alias("html"),
        F.lit("2024-12-31 06:00:00").cast("timestamp").alias("fetched_at"))


def site_known(spark: SparkSession, sf: str) -> DataFrame:
    """The site's news table before the run."""
    loaded = F.create_map(*[F.lit(x) for g, day in LOADED.items() for x in (SITE_LANGS[g], day)])
    rows = site_cards(spark, sf).where(F.col("dt") <= loaded[F.col("lang")].cast("date"))
    return merge.dedupe_batch(
        lookup.with_language_uid(articles(rows), site_lang_dim(spark)), ["lang_ord", "page_num", "pos"])

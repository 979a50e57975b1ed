"""Card arrays -> checked, numbered, dated cards.

All of it happens inside the array of one page: no explode, no window and no
shuffle before the stop rule has decided which pages count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.functions import checksum, dates
from tidings.functions import text as tx


def reject_reason(untitled: Column, unlinked: Column, text: Column, title: Column,
                  date_raw: Column) -> Column:
    """First failed check in order, NULL for an accepted card. ``title`` is the
    cleaned one; whether there was a title at all is judged before cleaning."""
    return (F.when(untitled, "no_title")
            .when(unlinked, "no_url")
            .when((text == "") & (title == ""), "no_text_title")
            .when(date_raw == "", "no_date"))


def text_or_title(text: Column, title: Column) -> Column:
    """An empty text takes the title."""
    return F.coalesce(F.nullif(text, F.lit("")), title)


def judge(listing: DataFrame, lang: Column, run_date, strict_dates: bool = False) -> DataFrame:
    """Replace raw ``cards`` by ``accepted`` and ``rejected`` arrays.

    Position numbers run over all candidates. A card's sequence number is its
    position plus the accepted cards before it: for the k-th accepted card that
    is ``pos + k``, for the r-th rejected one ``pos + (pos - 1 - r)``, both
    counted from 0. So each half is numbered by its own index, in linear time.
    """
    def clean(c, i):
        return F.struct(
            (i + 1).alias("pos"),
            tx.strip_symbols(tx.trim_space(c["title"])).alias("title"),
            tx.normalize_url(c["url"]).alias("url"),
            tx.normalize_url(tx.image_value(c["image"], c["image_attr"])).alias("thumbnail_url"),
            c["text"].alias("text"),
            c["date_raw"].alias("date_raw"),
            (c["title"] == "").alias("untitled"),
            (c["url"] == "").alias("unlinked"),
            (c["image"] == "").alias("no_thumb"),
            c["html"].alias("html"),
        )

    def check(c):
        reason = reject_reason(c["untitled"], c["unlinked"], c["text"], c["title"], c["date_raw"])
        return F.struct(*[c[n].alias(n) for n in
                          ("pos", "title", "url", "thumbnail_url", "date_raw", "no_thumb", "html")],
                        text_or_title(c["text"], c["title"]).alias("text"),
                        reason.alias("reason"))

    def number(c, seq, dated):
        fields = [c[n].alias(n) for n in ("pos", "title", "url", "thumbnail_url", "text", "date_raw")]
        more = ([dates.parse_date(c["date_raw"], lang, run_date, strict_dates).alias("dt")]
                if dated else [c["reason"].alias("reason")])
        return F.struct(seq.cast("int").alias("seq"), *fields, *more,
                        c["no_thumb"].alias("no_thumb"), c["html"].alias("html"))

    checked = F.transform(F.transform(F.col("cards"), clean), check)
    return (listing.withColumn("__c", checked)
            .withColumn("accepted", F.transform(
                F.filter("__c", lambda c: c["reason"].isNull()),
                lambda c, k: number(c, c["pos"] + k, True)))
            .withColumn("rejected", F.transform(
                F.filter("__c", lambda c: c["reason"].isNotNull()),
                lambda c, r: number(c, c["pos"] * 2 - 1 - r, False)))
            .drop("__c", "cards"))


def page_counts(judged: DataFrame, mark: Column) -> DataFrame:
    """Add ``cards`` and ``old`` per page from its accepted array.

    A card without a readable date counts as a card but never as old.
    """
    return (judged.withColumn("cards", F.size("accepted"))
            .withColumn("old", F.size(F.filter("accepted", lambda c: c["dt"] < mark))))


def _rows(judged: DataFrame, keep: tuple[str, ...], cards: Column | str) -> DataFrame:
    """One row per element. The outer form keeps the optimizer from testing the
    array for emptiness first, which would compute it twice."""
    return judged.select(*keep, F.inline_outer(cards)).where(F.col("pos").isNotNull())


def accepted_cards(judged: DataFrame, *keep: str) -> DataFrame:
    return _rows(judged, keep, "accepted").drop("no_thumb", "html")


def card_issues(judged: DataFrame, *keep: str) -> DataFrame:
    """Rows for the quarantine: rejected cards, and cards without image that got
    past the link check (``no_thumb``, a warning; ``stored`` tells if the card
    itself was accepted)."""
    def issue(c, reason, stored):
        return F.struct(*[c[n].alias(n) for n in
                          ("seq", "pos", "title", "url", "text", "date_raw", "html")],
                        reason.alias("reason"), F.lit(stored).alias("stored"))

    def warnings(cards, stored, warned):
        return F.transform(F.filter(cards, warned), lambda c: issue(c, F.lit("no_thumb"), stored))

    found = F.concat(
        F.transform("rejected", lambda c: issue(c, c["reason"], False)),
        warnings("rejected", False,
                 lambda c: c["no_thumb"] & c["reason"].isin("no_text_title", "no_date")),
        warnings("accepted", True, lambda c: c["no_thumb"]),
    )
    return _rows(judged, keep, found)


def split_by_mark(cards: DataFrame, mark: Column) -> tuple[DataFrame, DataFrame]:
    """(cards on or after the mark, cards before it); undated cards are in neither."""
    return cards.where(F.col("dt") >= mark), cards.where(F.col("dt") < mark)


REJECT = ("lang", "page_num", "pos", "seq", "title", "url", "text", "date_raw")


def undated_cards(cards: DataFrame) -> DataFrame:
    """Accepted cards whose date cannot be read (``bad_date``): they count for
    the stop rule, but are never stored."""
    return cards.where(F.col("dt").isNull()).select(*REJECT, F.lit("bad_date").alias("reason"))


def to_articles(cards: DataFrame, *keep: str) -> DataFrame:
    """Projection card -> article to store, with its checksum."""
    c = F.col
    return cards.select(
        *keep, "lang", "dt", "title", "text", "url", "thumbnail_url",
        c("seq").alias("sequence_num"),
        checksum.content_checksum(c("seq"), c("dt"), c("title"), c("text")).alias("check_sum"),
    )

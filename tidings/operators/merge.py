"""One batch of articles into the news table, keyed on URL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings import schema

NEWS_COLUMNS = schema.NEWS.fieldNames()
# Everything a match replaces: all but the key and the language.
REPLACED = [c for c in NEWS_COLUMNS if c not in ("url", "language_uid")]
# A batch up to this many bytes of text (and this many rows) is broadcast.
SMALL_BATCH_BYTES = 64 << 20
SMALL_BATCH_ROWS = 200_000


def dedupe_batch(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per URL: merging in ``order`` would leave the last values, under
    the language that came first. Combined on the map side before the shuffle."""
    by = F.struct(*order)
    last = F.max_by(F.struct(*[c for c in NEWS_COLUMNS if c not in ("url", "language_uid")]), by)
    first = F.min_by("language_uid", by)
    return (rows.groupBy("url").agg(last.alias("__last"), first.alias("language_uid"))
            .select("url", "language_uid", "__last.*").select(*NEWS_COLUMNS))


def is_small(batch: DataFrame, max_bytes: int = SMALL_BATCH_BYTES,
             max_rows: int = SMALL_BATCH_ROWS) -> bool:
    """Measured size of a batch; run it on materialised rows."""
    width = sum((F.coalesce(F.octet_length(c), F.lit(0))
                 for c in ("title", "text", "url", "thumbnail_url", "check_sum")), F.lit(0))
    size = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def merge_plan(news: DataFrame, batch: DataFrame, small: bool | None = None) -> DataFrame:
    """The news table after the merge, plus ``status`` per row.

    ``status`` is ``new``, ``updated``, ``unchanged`` (in the batch, same
    content) or ``kept`` (not in the batch). ``batch`` holds each URL once.

    A batch measured to be small is broadcast: the table is then read and
    written once and never shuffled. Otherwise both sides are joined by URL.
    """
    small = is_small(batch) if small is None else small
    return _merge_small(news, batch) if small else _merge_wide(news, batch)


def _merged(t: str, b: str):
    hit, had = F.col(f"{b}.url").isNotNull(), F.col(f"{t}.url").isNotNull()
    same = (F.col(f"{t}.check_sum").eqNullSafe(F.col(f"{b}.check_sum"))
            & F.col(f"{t}.thumbnail_url").eqNullSafe(F.col(f"{b}.thumbnail_url")))
    value = {c: F.when(hit, F.col(f"{b}.{c}")).otherwise(F.col(f"{t}.{c}")) for c in REPLACED}
    value["url"] = F.coalesce(f"{t}.url", f"{b}.url")
    value["language_uid"] = F.when(had, F.col(f"{t}.language_uid")).otherwise(
        F.col(f"{b}.language_uid"))
    status = (F.when(~hit, "kept").when(~had, "new").when(same, "unchanged").otherwise("updated"))
    return [*[value[c].alias(c) for c in NEWS_COLUMNS], status.alias("status")]


def _merge_wide(news: DataFrame, batch: DataFrame) -> DataFrame:
    joined = news.alias("t").join(batch.alias("b"), F.expr("t.url = b.url"), "full_outer")
    return joined.select(*_merged("t", "b"))


def _merge_small(news: DataFrame, batch: DataFrame) -> DataFrame:
    known = news.alias("t").join(F.broadcast(batch).alias("b"), F.expr("t.url = b.url"), "left")
    # URLs of the batch that are stored: no more rows than the batch has.
    stored = news.join(F.broadcast(batch.select("url")), "url", "left_semi").select("url").distinct()
    fresh = batch.join(F.broadcast(stored), "url", "left_anti")
    return known.select(*_merged("t", "b")).unionByName(
        fresh.select(*NEWS_COLUMNS, F.lit("new").alias("status")))


def merge_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def merge_into_table(batch: DataFrame, table: str) -> None:
    """The same merge on a catalog table that supports row-level changes."""
    (batch.alias("b").mergeInto(table, F.expr(f"{table}.url = b.url"))
     .whenMatched().update({c: F.col(f"b.{c}") for c in REPLACED})
     .whenNotMatched().insert({c: F.col(f"b.{c}") for c in NEWS_COLUMNS})
     .merge())

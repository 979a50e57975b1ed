"""Incremental runs over a stream of pages.

A run takes the pages that arrived since the last one (``availableNow``), stages
their new articles micro-batch by micro-batch and merges them once at its end:
the table is written once per run, and a URL that occurs in several micro-batches
ends as in one batch. There is no stop rule here: it needs all pages at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidings.operators import lookup, merge
from tidings.session import folder, sized


def frozen_marks(news: DataFrame, languages: DataFrame, lang_dim: DataFrame, run_date,
                 days_back: int) -> DataFrame:
    """Marks of one run; ``news`` may be the table's summary. Read once: marks taken anew in each micro-batch would
    rise with the cards just stored and drop those of later pages."""
    today = F.lit(str(run_date)).cast("date")
    return sized(lookup.high_water_marks(news, languages, lang_dim, today, days_back))


def new_and_late(cards: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cards to store and cards that only count, by the mark of their language."""
    dated = cards.join(marks, "lang")
    return (dated.where(F.col("dt") >= F.col("mark")).drop("mark"),
            dated.where(F.col("dt") < F.col("mark")).drop("mark"))


def late_per_page(late: DataFrame, *keys: str) -> DataFrame:
    """``keys, late``: how many cards of a micro-batch only count."""
    return late.groupBy(*keys).agg(F.count(F.lit(1)).alias("late"))


def late_counts(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Late cards of all micro-batches so far. Each has a folder of its own,
    which a repeated micro-batch replaced, so none counts twice."""
    fs = folder(spark, path)
    names = [n for n in fs.names() if n.startswith("batch=") and fs.has(f"{n}/_SUCCESS")]
    if not names:
        return spark.createDataFrame([], ", ".join([*(f"{k} string" for k in keys), "late long"]))
    return spark.read.parquet(*[f"{path}/{n}" for n in names]).groupBy(*keys).agg(F.sum("late").alias("late"))


def stage_articles(stream: DataFrame, to_articles: Callable[[DataFrame], DataFrame], stage: str,
                   checkpoint: str, late: str | None = None) -> StreamingQuery:
    """Write the articles of each micro-batch to a folder of its own.

    ``to_articles`` gives rows with ``language_uid`` and the order columns; with
    ``late``, a pair of these and of late counts, which go to a folder there. A
    micro-batch repeated after a failure replaces its folders.
    """
    def write(pages: DataFrame, batch_id: int) -> None:
        found = to_articles(pages)
        if late is not None:
            found, counts = found
            counts.write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        found.write.mode("overwrite").parquet(f"{stage}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def merge_staged(spark: SparkSession, stage: str, table, order: list[str]) -> int:
    """Merge everything staged, then drop it; the number of staged batches.

    If the run dies before the drop, the next one merges the same articles
    again, which leaves the table as it is.
    """
    fs = folder(spark, stage)
    names = [n for n in fs.names() if n.startswith("batch=") and fs.has(f"{n}/_SUCCESS")]
    if names:
        staged = spark.read.parquet(*[f"{stage}/{n}" for n in names])
        table.merge(merge.dedupe_batch(staged, order))
        for name in names:
            fs.delete(name)
    return len(names)


def ingest(stream: DataFrame, to_articles: Callable[[DataFrame], DataFrame], table,
           order: list[str], stage: str, checkpoint: str, late: str | None = None) -> int:
    """One incremental run, to its end."""
    stage_articles(stream, to_articles, stage, checkpoint, late).awaitTermination()
    return merge_staged(stream.sparkSession, stage, table, order)

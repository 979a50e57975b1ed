"""Sources of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidings import schema


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as fetched. No status is filtered: the last response counts."""
    return spark.read.schema(schema.PAGES).parquet(path)


def stream_pages(spark: SparkSession, path: str, layout: T.StructType = schema.PAGES,
                 files_per_batch: int | None = None, **options: str) -> DataFrame:
    """The same table as a stream. ``path`` is a directory."""
    reader = spark.readStream.schema(layout).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def spread(pages: DataFrame) -> DataFrame:
    """Use all cores where the files give fewer splits than there are cores.

    Parsing costs far more than moving a page. On large tables, which have more
    splits than cores, this does nothing and adds no shuffle.
    """
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages.repartition(cores) if pages.rdd.getNumPartitions() < cores else pages

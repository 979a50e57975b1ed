"""Checksum audit of the stored table: one narrow pass, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions.checksum import checksum_matches, content_checksum


CONTENT = ("sequence_num", "dt", "title", "text")


def refresh_checksums(news: DataFrame) -> DataFrame:
    """Every row with the checksum its content has now, and whether it changed."""
    now = content_checksum(*map(F.col, CONTENT))
    return (news.withColumn("__now", now)
            .withColumn("changed", ~F.col("check_sum").eqNullSafe(F.col("__now")))
            .withColumn("check_sum", F.col("__now")).drop("__now"))


def broken_checksums(news: DataFrame) -> DataFrame:
    """Rows whose stored checksum is missing or does not match their content."""
    fine = checksum_matches(F.col("check_sum"), *map(F.col, CONTENT))
    return news.where(~F.coalesce(fine, F.lit(False)))

"""Sinks: news table, quarantine, page archive, run statistics."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings import schema
from tidings.operators import audit, lookup, merge
from tidings.session import cut, folder, local_table


# Buckets of a new table; one that exists keeps its own number.
BUCKETS = 64
MANIFEST = T.StructType([
    T.StructField("bucket", T.IntegerType()),
    T.StructField("folder", T.StringType()),
    T.StructField("language_uid", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("newest", T.DateType()),
    T.StructField("buckets", T.IntegerType()),
])


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int").alias("bucket")


class NewsTable:
    """The news table as Parquet files in hash buckets of the URL.

    Parquet has no row-level merge and a path must not be overwritten while it
    is read. So a merge reads and rewrites the buckets its batch falls into,
    in a new folder, and leaves the others where they are. A manifest (``v=1``, ``v=2``, ...)
    names the current folder of every bucket and holds its rows and newest date per
    language, so that marks and counts read no data. A version counts once its manifest is
    committed (``_SUCCESS``), which is the last step: a run that died half way
    leaves files that no manifest names, and ``expire`` removes them. There is one writer at a
    time, as there is one scheduled run at a time.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def versions(self) -> list[int]:
        fs = folder(self.spark, self.root)
        found = [int(name[2:]) for name in fs.names() if name.startswith("v=")]
        return sorted(v for v in found if fs.has(f"v={v}/_SUCCESS"))

    def manifest(self, version: int | None = None) -> DataFrame:
        """``bucket, folder, language_uid, n, newest, buckets`` of a version, by
        default the newest; empty before the first."""
        versions = self.versions()
        if not versions:
            return local_table(self.spark, [], MANIFEST)
        at = versions[-1] if version is None else version
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/v={at}")

    def summary(self, version: int | None = None) -> DataFrame:
        """``language_uid, n, newest`` from the manifest alone."""
        return lookup.by_language(self.manifest(version))

    def read(self, version: int | None = None, only: Collection[int] | None = None) -> DataFrame:
        """The rows of a version, by default the newest; of some buckets if
        ``only`` names them. An empty table before the first version."""
        named = self.manifest(version)
        if only is not None:
            named = named.where(F.col("bucket").isin(list(only)))
        # As many folders as there are buckets at most.
        folders = sorted(r[0] for r in named.select("folder").distinct().collect())
        if not folders:
            return local_table(self.spark, [], schema.NEWS)
        return self.spark.read.schema(schema.NEWS).parquet(*[f"{self.root}/data/{name}" for name in folders])

    def _buckets(self) -> int:
        row = self.manifest().select("buckets").first()
        return row[0] if row else self.buckets

    def touched(self, rows: DataFrame) -> list[int]:
        """Numbers of the buckets that the URLs of ``rows`` fall into."""
        return sorted(r[0] for r in rows.select(bucket_of(self._buckets())).distinct().collect())

    def read_for(self, urls: DataFrame) -> DataFrame:
        """The rows of those buckets that may hold one of ``urls``: enough to
        look these up, and no other bucket is opened."""
        return self.read(only=self.touched(urls))

    def _commit(self, rows: DataFrame, replaced: Collection[int] | None) -> int:
        """Write ``rows`` as the new content of the replaced buckets (all, if
        None), then the manifest of the next version."""
        buckets, name = self._buckets(), f"w={uuid.uuid4().hex}"
        path = f"{self.root}/data/{name}"
        kept = self.manifest()
        kept = kept.limit(0) if replaced is None else kept.where(~F.col("bucket").isin(list(replaced)))
        placed = rows.select(*schema.NEWS.fieldNames()).withColumn("bucket", bucket_of(buckets))
        placed.repartition("bucket").write.partitionBy("bucket").parquet(path)
        stored = self.spark.read.schema(T.StructType([*schema.NEWS, T.StructField("bucket", T.IntegerType())])).parquet(path)
        fresh = stored.groupBy("bucket", "language_uid").agg(F.count(F.lit(1)).alias("n"), F.max("dt").alias("newest"))
        fresh = fresh.select("bucket", F.concat(F.lit(f"{name}/bucket="), "bucket").alias("folder"), "language_uid", "n", "newest",
                             F.lit(buckets).alias("buckets"))
        version = (self.versions() or [0])[-1] + 1
        # Some rows per bucket and language: one file, written in one step.
        kept.unionByName(fresh).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/v={version}")
        return version

    def write(self, news: DataFrame) -> int:
        """Replace all rows; they may be computed from the current ones."""
        return self._commit(news, None)

    def merge(self, batch: DataFrame) -> int:
        """Merge a batch that holds each URL once, into its buckets."""
        batch = cut(batch)
        touched = self.touched(batch)
        return self._commit(merge.merge_plan(self.read(only=touched), batch), touched)

    def refresh_checksums(self) -> int:
        """Recompute wrong checksums; the number of rows that changed. Buckets
        without any stay as they are."""
        per = (audit.broken_checksums(self.read()).groupBy(bucket_of(self._buckets()))
               .agg(F.count(F.lit(1)).alias("n")).collect())
        if per:
            broken = [r["bucket"] for r in per]
            self._commit(audit.refresh_checksums(self.read(only=broken)), broken)
        return sum(r["n"] for r in per)

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest versions, and data that none of these names."""
        fs, versions = folder(self.spark, self.root), self.versions()
        for version in versions[:-max(keep, 1)]:
            fs.delete(f"v={version}")
        used = {r[0] for v in versions[-max(keep, 1):] for r in self.manifest(v).select("folder").distinct().collect()}
        data = folder(self.spark, f"{self.root}/data")
        for name in data.names():
            parts = [f"{name}/{part}" for part in folder(self.spark, f"{self.root}/data/{name}").names() if part.startswith("bucket=")]
            if used.isdisjoint(parts):
                data.delete(name)
            else:
                for part in parts:
                    if part not in used:
                        data.delete(part)


class CatalogTable:
    """The news table in a catalog whose tables take row-level changes."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merge(self, batch: DataFrame) -> None:
        merge.merge_into_table(cut(batch), self.name)


# The sinks below write one folder per run: repeating a run replaces its rows.


def write_quarantine(issues: DataFrame, path: str, run: str) -> None:
    issues.write.mode("overwrite").partitionBy("reason").parquet(f"{path}/run={run}")


def write_page_archive(pages: DataFrame, path: str, run: str) -> None:
    pages.write.mode("overwrite").partitionBy("lang").parquet(f"{path}/run={run}")


def write_fetches(pages: DataFrame, path: str) -> None:
    """Append fetched pages to a folder by day of fetch, as a run reads them."""
    (pages.withColumn("fetch_date", F.to_date("fetched_at")).write.mode("append")
     .partitionBy("fetch_date").parquet(path))


def write_run_stats(stats: DataFrame, path: str, run: str) -> None:
    stats.write.mode("overwrite").parquet(f"{path}/run={run}")

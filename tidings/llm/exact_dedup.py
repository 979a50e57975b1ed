"""Exact duplicates through a minimal perfect hash over known digests.

The index is a table of buckets of about three digests. A bucket holds a seed
under which its digests fall on distinct slots 0..k-1, and in each slot the
full digest, the locator of the document that stays and the group's size: a
minimal perfect hash with no empty slot. A lookup is one equi-join on the
bucket, one multiplication, and a comparison of all 32 bytes; an unknown digest
falls on some slot and fails that comparison. A bucket for which no seed is
found keeps seed -1 and is searched by its digests, with the same result.

Defined cases: a null text counts as empty; a null id ranks below every id;
rows that repeat id and text are one document (the filter keeps one row); an
empty table gives an empty index and no rows; other columns, whatever their
names, are not touched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import digest_of, id_of, keep_rows, key_of
from tidings.session import written

PRIME = 2**31 - 1
LOAD = 3
TRIES = 1 << 17


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, digest) of every row, computed once."""
    return written(docs.select(key_of(id_col).alias("key"), digest_of(text_col).alias("digest")), "digests")


def _hashes() -> dict[str, Column]:
    return {"a": F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(PRIME)),
            "b": F.pmod(F.xxhash64(F.lit(2), "digest"), F.lit(PRIME - 1)) + 1}


def _slot(a: Column, b: Column, seed: Column, k: Column) -> Column:
    return F.pmod(F.pmod(a + seed * b, F.lit(PRIME)), k)


def find_seeds(a: list[np.ndarray], b: list[np.ndarray], tries: int = TRIES) -> np.ndarray:
    """For each bucket the smallest seed that spreads its keys over 0..k-1, or
    -1. All open buckets are tried at once with each seed."""
    size = np.array([len(x) for x in a], dtype=np.int64)
    out = np.full(len(a), -1, dtype=np.int64)
    live = np.flatnonzero((size > 0) & (size < 62))
    if not len(live):
        return out
    flat_a = np.concatenate([a[i] for i in live]).astype(np.int64)
    flat_b = np.concatenate([b[i] for i in live]).astype(np.int64)
    k = size[live]
    for seed in range(tries):
        owner = np.repeat(k, k)
        start = np.concatenate(([0], np.cumsum(k)[:-1]))
        bits = np.left_shift(np.int64(1), (flat_a + seed * flat_b) % PRIME % owner)
        good = np.bitwise_or.reduceat(bits, start) == (np.left_shift(np.int64(1), k) - 1)
        if good.any():
            out[live[good]] = seed
            rest = np.repeat(~good, k)
            flat_a, flat_b, live, k = flat_a[rest], flat_b[rest], live[~good], k[~good]
            if not len(live):
                break
    return out


@F.pandas_udf(T.LongType())
def _seed(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(find_seeds(list(a), list(b)))


def build_index(rows: DataFrame, keep: str = "max") -> DataFrame:
    """The index of the distinct digests in (key, digest): one row a bucket.
    ``keep`` says whether the largest or the smallest id of equal texts stays."""
    best = F.max if keep == "max" else F.min
    buckets = max(1, rows.count() // LOAD)
    groups = rows.groupBy("digest").agg(best("key").alias("winner"), F.count("*").alias("size"))
    entry = groups.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "digest", "winner", "size")
    packed = (entry.withColumns(_hashes()).groupBy("bucket")
              .agg(F.collect_list(F.struct("a", "b", "digest", "winner", "size")).alias("e"))
              .withColumn("seed", _seed(F.transform("e", lambda x: x.a), F.transform("e", lambda x: x.b))))
    slots = F.array_sort(F.transform("e", lambda x: F.struct(
        F.when(F.col("seed") >= 0, _slot(x.a, x.b, F.col("seed"), F.size("e").cast("long"))).alias("slot"),
        x.digest.alias("digest"), x.winner.alias("winner"), x["size"].alias("size"))))
    return written(packed.select("bucket", F.lit(buckets).cast("long").alias("buckets"), "seed", slots.alias("slots")), "mph")


def lookup(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with ``winner`` and ``size`` of the index, null for digests it
    does not hold."""
    first = index.select("buckets").first()
    buckets = first[0] if first else 1
    keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets))).withColumns(_hashes())
    found = keyed.join(index.select("bucket", "seed", "slots"), "bucket", "left")
    place = _slot(F.col("a"), F.col("b"), F.col("seed"), F.size("slots").cast("long"))
    hit = F.when(F.col("seed") >= 0, F.get("slots", place.cast("int"))).otherwise(
        F.get(F.filter("slots", lambda s: s.digest == F.col("digest")), F.lit(0)))
    found = found.withColumn("hit", hit)
    same = F.col("hit.digest") == F.col("digest")
    return found.select(*rows.columns, F.when(same, F.col("hit.winner")).alias("winner"),
                        F.when(same, F.col("hit.size")).alias("size"))


def dedup(rows: DataFrame, history: DataFrame | None = None, keep: str = "max") -> DataFrame:
    """(key, digest, winner, size, known) for every row of (key, digest).

    Without a history the index is built over the rows themselves. With one,
    rows found in it repeat a known document: their winner is its locator and
    none of them stays. Rows it does not hold are grouped among themselves.
    """
    if history is None:
        return lookup(rows, build_index(rows, keep)).withColumn("known", F.lit(False))
    found = written(lookup(rows, history), "lookup")
    members = found.where(F.col("winner").isNotNull()).withColumn("known", F.lit(True))
    new = found.where(F.col("winner").isNull()).select("key", "digest")
    best = F.max if keep == "max" else F.min
    groups = new.groupBy("digest").agg(best("key").alias("winner"), F.count("*").alias("size"))
    return members.unionByName(new.join(groups, "digest").withColumn("known", F.lit(False)))


def decisions(docs: DataFrame, history: DataFrame | None = None, keep: str = "max",
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    out = dedup(digests(docs, id_col, text_col), history, keep)
    return out.select(id_of("key").alias("doc_id"), id_of("winner").alias("keep_id"),
                      F.col("size").alias("group_size"),
                      (~F.col("known") & (F.col("key") == F.col("winner"))).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def survivors(docs: DataFrame, history: DataFrame | None = None, keep: str = "max",
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each text, with all their columns."""
    out = dedup(digests(docs, id_col, text_col), history, keep)
    kept = (out.where(~F.col("known") & (F.col("key") == F.col("winner")))
            .groupBy("key", "digest").agg(F.count("*").alias("rows")))
    return keep_rows(docs, kept, id_col, text_col)

"""What the operators share: row keys, whole-row filters, bounded batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a null id inside the operators; results show null again.
NO_ID = -(2**63)
_KEY, _DIGEST, _ROWS = "_llm_key", "_llm_digest", "_llm_rows"

U64 = np.uint64


def key_of(column: str) -> Column:
    """An id as a long that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_of(key: str) -> Column:
    """The id a key stands for."""
    return F.when(F.col(key) != NO_ID, F.col(key))


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def digest_of(column: str) -> Column:
    """SHA-256 of a text in UTF-8, as 32 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(text_of(column), 256))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` named in ``kept`` (key, digest, rows), all columns
    unchanged; of rows that repeat id and text only one is returned.

    ``rows`` is how many rows share id and text. Only groups of more than one
    row take the second branch, where equal rows meet in a map-side aggregate
    before they are shuffled, so even a hot id is never gathered whole. Both
    branches reuse one shuffle of the documents.
    """
    names = docs.columns
    keyed = docs.withColumns({_KEY: key_of(id_col), _DIGEST: digest_of(text_col)})
    named = kept.select(F.col("key").alias(_KEY), F.col("digest").alias(_DIGEST), F.col("rows").alias(_ROWS))
    joined = keyed.join(named, [_KEY, _DIGEST])
    once = joined.where(F.col(_ROWS) == 1).select(names)
    again = joined.where(F.col(_ROWS) > 1).dropDuplicates([_KEY, _DIGEST]).select(names)
    return once.unionByName(again)


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes add up to about ``limit``; every
    row is in one range, however large it is."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public SplitMix64 constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))

"""Content checksums as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_text(c: Column) -> Column:
    """SHA-256 of the UTF-16LE text, upper-case hex."""
    return F.upper(F.sha2(F.encode(c, "UTF-16LE"), 256))


def sha256_bytes(c: Column) -> Column:
    """SHA-256 of bytes, upper-case hex."""
    return F.upper(F.sha2(c, 256))


def content_checksum(seq: Column, day: Column, title: Column, text: Column,
                     image: Column | None = None) -> Column:
    """Five hashes of 64 characters, joined: position, ISO day, title, text, image.

    Listings carry no image bytes; the last part is then a constant.
    """
    image = F.lit(b"") if image is None else image
    return F.concat(
        sha256_text(seq.cast("string")),
        sha256_text(F.date_format(day, "yyyy-MM-dd")),
        sha256_text(title),
        sha256_text(text),
        sha256_bytes(image),
    )


def checksum_matches(stored: Column, seq: Column, day: Column, title: Column, text: Column,
                     image: Column | None = None) -> Column:
    """True where the stored checksum is the one recomputed from the row."""
    return content_checksum(seq, day, title, text, image) == stored

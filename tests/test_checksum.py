import datetime as dt
import hashlib

from pyspark.sql import functions as F

from tidings.functions import checksum
from tidings.operators import audit


def h(text):
    return hashlib.sha256(text.encode("utf-16-le")).hexdigest().upper()


def test_hash_of_text(apply):
    texts = ["", "abc", "Новость", "😀 x"]
    assert apply(checksum.sha256_text, texts) == [h(t) for t in texts]


def test_content_checksum(spark):
    rows = spark.createDataFrame([(3, dt.date(2023, 4, 9), "Мост открыт", "Содержание")],
                                 "seq int, day date, title string, text string")
    cols = [F.col(n) for n in rows.columns]
    plain, image = rows.select(checksum.content_checksum(*cols),
                               checksum.content_checksum(*cols, F.lit(b"img"))).first()
    first = h("3") + h("2023-04-09") + h("Мост открыт") + h("Содержание")
    assert plain == first + hashlib.sha256(b"").hexdigest().upper()
    assert image == first + hashlib.sha256(b"img").hexdigest().upper()
    assert len(plain) == 320


def test_verify_and_refresh(spark):
    rows = spark.createDataFrame([(1, dt.date(2025, 1, 1), "t", "x", "a"), (2, dt.date(2025, 1, 1), "u", "x", "b")],
                                 "sequence_num int, dt date, title string, text string, url string")
    stored = rows.withColumn("check_sum", checksum.content_checksum(
        *[F.col(n) for n in ("sequence_num", "dt", "title", "text")]))
    touched = stored.withColumn("title", F.when(F.col("url") == "b", "changed").otherwise(F.col("title")))
    assert audit.broken_checksums(stored).count() == 0
    assert [r.url for r in audit.broken_checksums(touched).collect()] == ["b"]
    fixed = audit.refresh_checksums(touched)
    assert fixed.where("changed").count() == 1
    assert audit.broken_checksums(fixed).count() == 0
    lost = stored.withColumn("check_sum", F.lit(None).cast("string"))
    assert audit.broken_checksums(lost).count() == 2

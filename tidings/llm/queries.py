"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.llm import (decontamination, exact_dedup, language_id, mixing, near_dedup, neighbours, packing, periodic_runs, quality,
                         surrogates, token_links, url_filter, warc)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Rates and copies of all documents."""
    return mixing.rates(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op2_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of near copies: three words, 85 per cent."""
    return near_dedup.decisions(_table(spark, sf, "documents"), width=3, percent=85)


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    """All pages written as archives and read back."""
    return warc.round_trip(_table(spark, sf, "pages"))


def op4_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest of every fiftieth vector among all."""
    return neighbours.search(_table(spark, sf, "embeddings"), F.col("id") % 50 == 0)


# For the registered query only; a real run takes its key from a secret store.
KEY = b"key of the registered query"


def op5_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    return surrogates.pseudonymise(_table(spark, sf, "documents"), KEY)


def op6_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup.decisions(_table(spark, sf, "documents"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of all documents, learnt from four fifths of the labels."""
    docs = _table(spark, sf, "documents")
    model = quality.fit(docs.where(~quality.held_out()), _table(spark, sf, "labels"))
    return quality.scores(docs, model)


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Token pieces of all documents in sequences of 2,048."""
    return packing.pack(packing.pieces(_table(spark, sf, "documents"), TOKENIZER))


RULES = [url_filter.rule_of("org/", "allow"), url_filter.rule_of("example.org/es/", "block"),
         url_filter.rule_of("example.org/en/1", "block"), url_filter.rule_of("com/fr/", "allow"),
         url_filter.rule_of("com/de/", "block")]


def op9_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts on all pages' urls."""
    return url_filter.judge(_table(spark, sf, "pages"), url_filter.rule_table(spark, RULES))


def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    """Language of all documents, learnt from two thirds of them."""
    docs = _table(spark, sf, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.predictions(docs, model)


def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of repeating words in all documents, with runs planted in a tenth."""
    docs = _table(spark, sf, "documents").withColumn("text", periodic_runs.planted())
    return periodic_runs.digest(periodic_runs.runs(docs))


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Linked tokens of two tokenizers over all documents."""
    return token_links.alignments(_table(spark, sf, "documents"), BYTE_BPE, PIECES)


def op13_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of ten words of all benchmark items in all documents."""
    found = decontamination.search(decontamination.build(_table(spark, sf, "documents")),
                                   decontamination.windows(_table(spark, sf, "benchmark")))
    return decontamination.decisions(found)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_minhash": op2_minhash,
    "op3_warc": op3_warc,
    "op4_neighbours": op4_neighbours,
    "op5_surrogates": op5_surrogates,
    "op6_exact": op6_exact,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_urls": op9_urls,
    "op10_language": op10_language,
    "op11_runs": op11_runs,
    "op12_alignment": op12_alignment,
    "op13_decontamination": op13_decontamination,
}

SQL = {
    "op3_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to, true AS intact
FROM w""",
    "op6_exact": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d""",
    # The checksum bit by bit; equal words a period apart; stretches of them.
    "op11_runs": r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
                  xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) AS h
           FROM documents),
u AS (SELECT *, len(w) AS n, (h // 10) % len(w) AS a, 3 + (h // 10) % 8 AS parts FROM t),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
                  CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END) ELSE w END AS w FROM u),
p AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM d),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM p x JOIN p y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM m),
l AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM l GROUP BY doc_id, start, length),
o AS (SELECT doc_id, count(*) AS n_runs, arg_min({'s': start, 'l': length, 'p': period}, {'a': -length, 'b': start, 'c': period}) AS best,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
z AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS kept FROM p ANTI JOIN z ON p.doc_id = z.doc_id AND p.i = z.i GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
       1000 * best.l // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op13_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT item_id, least(len(w), 10) AS k, unnest(range(greatest(len(w) - 9, 1))) AS i, w FROM b WHERE len(w) > 0),
x AS (SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS s FROM g),
p AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d),
h AS (SELECT DISTINCT p.doc_id, p.i, x.item_id, x.k FROM p, (SELECT DISTINCT k FROM x) q, x
      WHERE x.k = q.k AND p.i + q.k <= len(p.w) AND array_to_string(p.w[p.i + 1:p.i + q.k], ' ') = x.s),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
}

"""Language identification by bit-sliced Bloom filters over character n-grams.

One table of ``slots`` rows holds a bit per language in each row. An n-gram
sets its languages' bits in ``PROBES`` rows; the AND of those rows returns all
languages whose filter contains it, in one look. A text is read as n-grams of
lower-cased letters, words set off by a space. Per language the hits are
counted, corrected for the filter's false positives by its fill, and the
language that holds the largest share of the text's n-grams is predicted.

An n-gram enters a language's filter when it occurs there at least
``MIN_COUNT`` times and at no less than ``SHARE`` of the rate of the language
where it is most frequent. The filters are fitted on labelled documents; from
more than ``fit_rows`` of them, whole documents are drawn by a hash of the id,
per language: the rows are dealt out evenly, and what a rare language leaves
over goes to the others, so that a rare language is learnt from all its
documents whatever the size of the corpus. A language with fewer than
``ROWS_PER_COUNT`` documents for each of the ``MIN_COUNT`` needs fewer
occurrences. The table has a fixed size, whatever the corpus.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language first in order; no labelled documents: every text is
``und``; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import U64, mix, slices
from tidings.session import page_batches

GRAMS = (3, 4)
PROBES = 3
SLOTS = 1 << 18
MIN_COUNT = 5
ROWS_PER_COUNT = 2
SHARE = 0.3
FIT_ROWS = 30_000
# Characters read at once: an n-gram takes some 150 bytes while it is hashed.
STEP = 250_000
# Counted n-grams that a task holds.
HELD = 500_000
UND = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, 0 for runs of anything but letters, each text
    set off by 0; and the number of code points kept per text."""
    parts = ["\n\n" if t is None else f"\n{t.lower()}\n" for t in texts]
    # A surrogate cannot occur in a text from Spark.
    flat = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    is_letter = letters()[flat]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:1] = True
    keep[1:] |= owner[1:] != owner[:-1]
    return np.where(is_letter, flat, 0)[keep].astype(U64), np.bincount(owner[keep], minlength=len(parts))


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of all texts and the text each belongs to."""
    flat, size = codes(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    hashes, owners = [], []
    for n in GRAMS:
        if len(flat) < n:
            continue
        h = np.full(len(flat) - n + 1, n, dtype=U64)
        for i in range(n):
            h = h * U64(0x9E3779B97F4A7C15) + flat[i:len(flat) - n + 1 + i]
        inside = owner[:len(h)] == owner[n - 1:]
        # A space inside an n-gram would join two words.
        for i in range(1, n - 1):
            inside &= flat[i:len(h) + i] != 0
        hashes.append(mix(h[inside]))
        owners.append(owner[:len(h)][inside])
    if not hashes:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int32)
    return np.concatenate(hashes), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # slots x words of 63 languages
    chance: np.ndarray  # of a false hit, per language

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Per text and language the share of its n-grams that the language's
        filter holds, corrected for false positives; -1 without n-grams."""
        h, owner = grams(texts)
        count = np.bincount(owner, minlength=len(texts))
        out = np.full((len(texts), len(self.languages)), -1.0)
        some = count > 0
        if not some.any():
            return out
        mask = None
        for j in range(PROBES):
            row = self.table[((h >> U64(20 * j)) & U64(len(self.table) - 1)).astype(np.int64)]
            mask = row if mask is None else mask & row
        for i in range(len(self.languages)):
            bit = (mask[:, i // 63] >> (i % 63)) & 1
            hit = np.bincount(owner, weights=bit, minlength=len(texts))[some] / count[some]
            out[some, i] = np.clip((hit - self.chance[i]) / max(1e-9, 1 - self.chance[i]), 0, 1)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score = [UND] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return lang, score
        share = self.shares(texts)
        best = share.argmax(axis=1)
        top = share[np.arange(len(texts)), best]
        total = share.sum(axis=1)
        for i in np.flatnonzero(top >= 0):
            lang[i] = self.languages[best[i]]
            score[i] = top[i] / total[i] if total[i] > 0 else 0.0
        return lang, score


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def added() -> Iterator[pa.RecordBatch]:
        for i, parts in held.items():
            name, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([p[1] for p in parts]), minlength=len(name))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(name), i, dtype=np.int32)),
                                              pa.array(name.view(np.int64)), pa.array(n.astype(np.int64))],
                                             names=["l", "g", "n"])

    for batch in batches:
        texts, lang = batch.column("text").to_pylist(), np.array(batch.column("l").to_pylist())
        for lo, hi in slices([len(t) for t in texts], STEP):
            h, owner = grams(texts[lo:hi])
            for i in np.unique(lang[lo:hi]).tolist():
                part = np.unique(h[lang[lo:hi][owner] == i], return_counts=True)
                held.setdefault(i, []).append(part)
                size += len(part[0])
            if size > HELD:
                yield from added()
                held, size = {}, 0
    yield from added()


def quota(sizes: Iterable[int], fit_rows: int) -> float:
    """The most rows of one language that can be drawn, such that no more than
    ``fit_rows`` are drawn in all and none are left over without need."""
    left = fit_rows
    sizes = sorted(sizes)
    for i, n in enumerate(sizes):
        even = left / (len(sizes) - i)
        if n > even:
            return even
        left -= n
    return float("inf")


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, slots: int = SLOTS) -> Model:
    """Filters of all languages among the labelled documents."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    per_lang = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    languages = sorted(per_lang)
    words = max(1, -(-len(languages) // 63))
    page_batches(labelled.sparkSession)
    table = np.zeros((slots, words), dtype=np.int64)
    if not languages:
        return Model([], table, np.zeros(0))
    most = quota(per_lang.values(), fit_rows)
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col(lang_col)).cast("int") - 1
    # In 2^40ths: a language may need a very small share.
    bound = F.array(*[F.lit(int(min(1.0, most / per_lang[x]) * (1 << 40))) for x in languages])
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("language id"), id_col), F.lit(1 << 40)) < F.get(bound, number))
    weights = dict(per_lang)
    if most < max(per_lang.values()):
        weights |= {r[0]: r[1] for r in drawn.groupBy(lang_col).count().collect()}
    least = {x: MIN_COUNT if per_lang[x] > most else max(1, min(MIN_COUNT, per_lang[x] // ROWS_PER_COUNT)) for x in languages}
    counts = (drawn.select(F.col(text_col).alias("text"), number.alias("l")).mapInArrow(_count, "l int, g long, n long")
              .groupBy("g", "l").agg(F.sum("n").alias("n")).groupBy("g")
              .agg(F.collect_list(F.struct("l", "n")).alias("per"), F.sum("n").alias("all"))
              .where(F.col("all") >= min(least.values())))
    # Rates compare languages of unequal size and are drawn with unequal shares.
    weight = F.array(*[F.lit(1.0 / weights[x]) for x in languages])
    enough = F.array(*[F.lit(least[x]) for x in languages])
    rate = lambda x: x.n * F.get(weight, x.l)
    top = F.array_max(F.transform("per", rate))
    chosen = F.filter("per", lambda x: (x.n >= F.get(enough, x.l)) & (rate(x) >= top * SHARE))
    probes = F.array(*[F.shiftright("g", 20 * j).bitwiseAND(F.lit(slots - 1)) for j in range(PROBES)])
    bits = (counts.select(F.explode(probes).alias("slot"), chosen.alias("per"))
            .select("slot", F.explode("per").alias("x"))
            .groupBy("slot", (F.col("x.l") / 63).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, x.l % 63)")).alias("mask")))
    # At most one row per slot and word of languages: a fixed bound.
    got = bits.toPandas()
    table[got["slot"].to_numpy(np.int64), got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64)
    fill = np.array([((table[:, i // 63] >> (i % 63)) & 1).mean() for i in range(len(languages))])
    return Model(languages, table, fill ** PROBES)


def predictor(model: Model, spark, text_col: str = "text") -> Column:
    """Struct (lang, score) of the text."""
    shared = spark.sparkContext.broadcast(model)
    page_batches(spark)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = [t if isinstance(t, str) else None for t in texts]
            lang, score = [], []
            for lo, hi in slices([len(t or "") for t in values], STEP):
                a, b = shared.value.predict(values[lo:hi])
                lang += a
                score.append(b)
            yield pd.DataFrame({"lang": lang, "score": np.concatenate(score) if score else np.zeros(0)})

    # Marked so that the optimizer neither repeats nor moves it.
    return run.asNondeterministic()(F.col(text_col))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from fitting: crc32 of its id mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predictions(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = out.select("doc_id", held_out("doc_id").alias("held_out"), predictor(model, docs.sparkSession, "text").alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents in a language the model knows, with all their columns;
    ``und`` and texts no filter holds an n-gram of are rejected."""
    names = docs.columns
    out = docs.withColumn("_llm_lang", predictor(model, docs.sparkSession, text_col))
    return out.where((F.col("_llm_lang.lang") != UND) & (F.col("_llm_lang.score") > 0)).select(names)

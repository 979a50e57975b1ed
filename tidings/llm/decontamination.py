"""Benchmark passages in documents, found through an FM-index per shard.

A task cuts its documents into shards of about ``SHARD`` words and writes for
each a full-text index over words: the Burrows-Wheeler transform of its word
numbers as a wavelet matrix (one bit vector for each bit of a number), the vocabulary,
and every ``SAMPLE``-th suffix position of each document. The index holds no
word of any benchmark and serves every later search.

A search takes the distinct windows of the benchmark, in blocks of at most
``BLOCK``, and steps all windows of a block backwards at once: a step is one
rank at both ends of a window's suffix range for each bit. What is left of a
range are the window's occurrences; each is walked back to the next sampled
suffix, which says where it stands. The spans are merged by document.

Words are what stands between bytes other than letters and digits of ASCII,
A-Z lower-cased; a window is ``width`` consecutive words of an item, and an item of
fewer words is one window. A document longer than ``LONG`` words is indexed in
segments that overlap by a window, and its spans are merged by a shuffle.

Defined cases: a null or empty text, or one without words, has no words and no
hits; an item without words has no window; a very long text is spread over
segments; windows that several items share count for each of them; rows that
repeat an item's id are one item; an item without an id marks words, but is not listed; rows
that repeat a document's id, or have none, are documents of their own; an empty table of
documents gives no rows, an empty benchmark no hits; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.common import U64, digest_of, key_of, text_of
from tidings.session import written

WIDTH = 10
SHARD = 1 << 19
LONG = 1 << 18
SAMPLE = 16
# Windows searched at once; their words are the only thing sent to every task.
BLOCK = 50_000
# Occurrences walked back at once.
WALK = 1 << 18
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The same by bytes: a space for what is in no word. UTF-8 has no byte of ASCII in other characters.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[str]:
    return list(filter(None, text.encode().translate(FOLD).decode().split(" ")))


class Numbers(dict):
    """Numbers of words from 1 on, given as they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self) + 1
        return number


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes. ``codes`` end with a code that
    occurs nowhere else, as all separators do, so that no order is left open.
    Three codes are sorted at once, then ranks of twice the depth, only among
    suffixes that are still alike."""
    n, bits = len(codes), 21
    padded = np.concatenate((codes.astype(np.int64) + 1, np.zeros(2, np.int64)))
    if padded.max(initial=0) >> bits:
        raise ValueError("a shard holds more than 2 million words")
    key = (padded[:n] << (2 * bits)) | (padded[1:n + 1] << bits) | padded[2:]
    order = np.argsort(key)
    sorted_ = key[order]
    start = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    first = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    rank[order] = first
    depth = 3
    open_ = np.flatnonzero(~(start & np.append(start[1:], True)))
    while len(open_):
        at = order[open_]
        next_ = rank[np.minimum(at + depth, n)]
        key = (first[open_] << 32) | (next_ + 1)
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[open_] = at
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first[open_] = np.maximum.accumulate(np.where(new, open_, 0))
        rank[at] = first[open_]
        open_ = open_[~(new & np.append(new[1:], True))]
        depth *= 2
    return order


class Bits:
    """A bit vector with ranks."""

    def __init__(self, packed: np.ndarray, n: int):
        self.n = n
        self.words = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed).astype(np.int64))))

    @staticmethod
    def pack(bits: np.ndarray) -> bytes:
        raw = np.packbits(bits, bitorder="little")
        return np.concatenate((raw, np.zeros(8 - len(raw) % 8, dtype=np.uint8))).tobytes()

    @classmethod
    def load(cls, raw: bytes, n: int) -> Bits:
        return cls(np.frombuffer(raw, dtype="<u8"), n)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bits are set."""
        word, bit = at >> 6, (at & 63).astype(U64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((U64(1) << bit) - U64(1)))

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(U64)) & U64(1)


class Wavelet:
    """A wavelet matrix: level by level from the highest bit, zeros before ones."""

    def __init__(self, levels: list[Bits]):
        self.levels = levels
        self.zeros = [b.n - int(b.ones(np.array([b.n]))[0]) for b in levels]

    @staticmethod
    def pack(symbols: np.ndarray, bits: int) -> list[bytes]:
        out = []
        for k in range(bits - 1, -1, -1):
            bit = ((symbols >> k) & 1).astype(bool)
            out.append(Bits.pack(bit))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))
        return out

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``at`` symbols."""
        start, end = np.zeros(len(at), dtype=np.int64), at
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = ((symbol >> (len(self.levels) - 1 - k)) & 1).astype(bool)
            ones_s, ones_e = level.ones(start), level.ones(end)
            start = np.where(one, zeros + ones_s, start - ones_s)
            end = np.where(one, zeros + ones_e, end - ones_e)
        return end - start

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), dtype=np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one = level[at].astype(bool)
            out = out * 2 + one
            ones = level.ones(at)
            at = np.where(one, zeros + ones, at - ones)
        return out


def index(documents: list[list[str]]) -> dict:
    """The index of a shard: blobs of its vocabulary, transform and samples.
    Symbol 0 parts the documents; words are numbered from 1 as they are met."""
    number = Numbers()
    size = np.array([len(d) for d in documents], dtype=np.int64)
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    n = int(size.sum()) + len(size)
    symbols = np.zeros(n, dtype=np.int64)
    for d, at in zip(documents, begin.tolist()):
        symbols[at:at + len(d)] = np.fromiter(map(number.__getitem__, d), np.int64, len(d))
    # In the order every separator is a code of its own, below all words.
    parts = begin + size
    codes = symbols + len(size) - 1
    codes[parts] = np.arange(len(size))
    order = suffix_order(codes)
    transform = symbols[order - 1]
    within = order - np.repeat(begin, size + 1)[order]
    marked = within % SAMPLE == 0
    bits = max(1, int(len(number)).bit_length())
    return {"n": n, "begin": begin.astype("<u4").tobytes(), "vocabulary": "\n".join(number),
            "counts": np.bincount(symbols, minlength=len(number) + 1).astype("<u4").tobytes(),
            "levels": Wavelet.pack(transform, bits), "marked": Bits.pack(marked), "sample": order[marked].astype("<u4").tobytes()}


class Searcher:
    """Backward search and location in one shard."""

    def __init__(self, row: dict):
        n = row["n"]
        self.symbols = {w: i for i, w in enumerate(row["vocabulary"].split("\n"), 1)}
        counts = np.frombuffer(row["counts"], dtype="<u4").astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.wavelet = Wavelet([Bits.load(b, n) for b in row["levels"]])
        self.marked = Bits.load(row["marked"], n)
        self.sample = np.frombuffer(row["sample"], dtype="<u4").astype(np.int64)

    def ranges(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of windows: rows of symbols, filled up at their end
        with -1; a word that the shard lacks is 0."""
        n, width = windows.shape
        lo, hi = np.zeros(n, dtype=np.int64), np.full(n, self.first[-1])
        live = (windows != 0).all(axis=1)
        hi[~live] = 0
        at = np.flatnonzero(live)
        for k in range(width - 1, -1, -1):
            here = at[windows[at, k] > 0]
            symbol = windows[here, k]
            lo[here] = self.first[symbol] + self.wavelet.rank(symbol, lo[here])
            hi[here] = self.first[symbol] + self.wavelet.rank(symbol, hi[here])
            at = at[lo[at] < hi[at]]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in ``rows``; no walk leaves a document, as
        its first word is sampled."""
        out, steps = np.full(len(rows), -1, dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.marked[rows[todo]].astype(bool)
            done = todo[hit]
            out[done] = self.sample[self.marked.ones(rows[done])] + steps[done]
            todo = todo[~hit]
            symbol = self.wavelet.symbol(rows[todo])
            rows[todo] = self.first[symbol] + self.wavelet.rank(symbol, rows[todo])
            steps[todo] += 1
        return out


INDEX = ("shard long, n long, begin binary, vocabulary string, counts binary, levels array<binary>, marked binary, sample binary, "
         "key array<long>, doc_id array<long>, digest array<binary>, offset array<long>, n_words array<long>")
_ARROW = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("begin", pa.binary()), ("vocabulary", pa.string()), ("counts", pa.binary()),
                    ("levels", pa.list_(pa.binary())), ("marked", pa.binary()), ("sample", pa.binary()), ("key", pa.list_(pa.int64())),
                    ("doc_id", pa.list_(pa.int64())), ("digest", pa.list_(pa.binary())), ("offset", pa.list_(pa.int64())),
                    ("n_words", pa.list_(pa.int64()))])


def _indexed(width: int, shard_words: int, long: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = shard = TaskContext.get().partitionId() << 33
        parts, held = [], 0

        def done() -> pa.RecordBatch:
            row = index([p[4] for p in parts]) | {"shard": shard, "key": [p[0] for p in parts], "doc_id": [p[1] for p in parts],
                                                  "digest": [p[2] for p in parts], "offset": [p[3] for p in parts],
                                                  "n_words": [p[5] for p in parts]}
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _ARROW], schema=_ARROW)

        for batch in batches:
            for doc_id, digest, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "digest", "text"))):
                words = words_of(text)
                for at in range(0, max(len(words), 1), long):
                    # A segment owns ``long`` words and holds the start of the next.
                    part = words[at:at + long + width - 1]
                    parts.append((key, doc_id, digest, at, part, min(len(words) - at, long)))
                    held += len(part) + 1
                    if held >= shard_words:
                        yield done()
                        parts, held, shard = [], 0, shard + 1
                key += 1
        if parts:
            yield done()
    return run


def build(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
          shard_words: int = SHARD, long: int = LONG) -> DataFrame:
    """The written index of ``docs``, a row per shard, for windows of up to ``width`` words."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))
    return written(rows.mapInArrow(_indexed(width, shard_words, long), INDEX), "fm")


def _windowed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                found = {" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else ()
                ids += [i] * len(found)
                out += found
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(ids, pa.int64())), pa.array(out, pa.string())],
                                             names=["item_id", "words"])
    return run


def windows(benchmark: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, words, item_id): the windows of every item, once each; equal
    windows have one number."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item_id"), text_of(text_col).alias("text"))
    of = written(rows.mapInArrow(_windowed(width), "item_id string, words string").distinct(), "windows")
    distinct = written(of.select("words").distinct().withColumn("window", F.monotonically_increasing_id()), "distinct_windows")
    return of.join(distinct, "words").select("window", "words", "item_id")


def _search(numbers: list[int], spelled: list[list[str]], width: int, walk: int):
    vocabulary = list(dict.fromkeys(w for words in spelled for w in words))
    place = {w: i for i, w in enumerate(vocabulary)}
    shape = np.full((len(spelled), width), -1, dtype=np.int64)
    for i, words in enumerate(spelled):
        shape[i, :len(words)] = [place[w] for w in words]
    number, size = np.array(numbers, dtype=np.int64), np.array([len(w) for w in spelled], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                searcher = Searcher(row)
                here = np.array([searcher.symbols.get(w, 0) for w in vocabulary], dtype=np.int64)
                lo, hi = searcher.ranges(np.where(shape < 0, -1, here[shape]))
                begin = np.frombuffer(row["begin"], dtype="<u4").astype(np.int64)
                key, offset = np.array(row["key"], dtype=np.int64), np.array(row["offset"], dtype=np.int64)
                found = np.flatnonzero(lo < hi)
                # Each occurrence starts at a place of its own, but for windows
                # of other lengths, so these are bounded by the shard.
                ends = np.cumsum(hi[found] - lo[found])
                for first in range(0, int(ends[-1]) if len(ends) else 0, walk):
                    nth = np.arange(first, min(first + walk, int(ends[-1])))
                    which = np.searchsorted(ends, nth, side="right")
                    window = found[which]
                    at = searcher.locate(hi[window] - (ends[which] - nth))
                    doc = np.searchsorted(begin, at, side="right") - 1
                    start = at - begin[doc] + offset[doc]
                    yield pa.RecordBatch.from_arrays([pa.array(key[doc]), pa.array(number[window]), pa.array(start),
                                                      pa.array(start + size[window])], names=["key", "window", "start", "end"])
    return run


def occurrences(table: DataFrame, wanted: DataFrame, width: int = WIDTH, most: int = BLOCK, walk: int = WALK) -> DataFrame:
    """(key, window, start, end) of every window of ``wanted`` (window, words)
    in the indexed documents, in blocks of windows whose size is bounded."""
    spark = table.sparkSession
    many = wanted.count()
    blocks = max(1, -(-many // (most // 2)))
    block = F.pmod(F.xxhash64("words"), F.lit(blocks))
    out = None
    for b in range(blocks):
        rows = wanted.where(block == b).collect()
        part = table.select("n", "begin", "vocabulary", "counts", "levels", "marked", "sample", "key", "offset").mapInArrow(
            _search([r["window"] for r in rows], [r["words"].split(" ") for r in rows], width, walk),
            "key long, window long, start long, end long")
        part = written(part, "occurrences")
        out = part if out is None else out.unionByName(part)
    return out


def search(table: DataFrame, of: DataFrame, width: int = WIDTH, most: int = BLOCK, walk: int = WALK) -> DataFrame:
    """(key, doc_id, digest, n_words, spans, items) for every indexed document:
    merged spans of hit words, and the distinct items found, sorted."""
    docs = table.select(F.explode(F.arrays_zip("key", "doc_id", "digest", "n_words")).alias("d")).select("d.*")
    whole = docs.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("digest").alias("digest"), F.sum("n_words").alias("n_words"))
    met = occurrences(table, of.select("window", "words").distinct(), width, most, walk)
    spans = merged(met)
    items = (met.select("key", "window").distinct().join(of.where("item_id IS NOT NULL").select("window", "item_id"), "window")
             .groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    return (whole.join(spans, "key", "left").join(items, "key", "left")
            .withColumns({"spans": F.coalesce("spans", none), "items": F.coalesce("items", F.expr("cast(array() as array<string>)"))}))


def merged(met: DataFrame) -> DataFrame:
    """(key, spans): overlapping or touching spans of a document as one."""
    order = Window.partitionBy("key").orderBy("start", "end")
    once = met.groupBy("key", "start").agg(F.max("end").alias("end"))
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    part = once.withColumn("new", F.when(before >= F.col("start"), 0).otherwise(1))
    part = part.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    one = part.groupBy("key", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return one.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def decisions(found: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x.end - x.start)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, found in zip(texts, spans):
        places = [m.span() for m in WORDS.finditer(text.translate(LOWER))]
        kept, at = [], 0
        for s in found:
            kept.append(text[at:places[s["start"]][0]])
            at = places[s["end"] - 1][1]
        out.append("".join([*kept, text[at:]]))
    return pd.Series(out, dtype=object)


def cleaned(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, hit words and what stands between them cut
    from the texts; ``found`` is the result of ``search`` over them."""
    names = docs.columns
    cut = (found.where(F.size("spans") > 0).groupBy(F.coalesce("doc_id", key_of("doc_id")).alias("_llm_key"), F.col("digest").alias("_llm_digest"))
           .agg(F.first("spans").alias("_llm_spans")))
    keyed = docs.withColumns({"_llm_key": key_of(id_col), "_llm_digest": digest_of(text_col)}).join(cut, ["_llm_key", "_llm_digest"], "left")
    changed = F.when(F.col("_llm_spans").isNotNull(), _cut(text_of(text_col), F.coalesce(
        "_llm_spans", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")))).otherwise(F.col(text_col))
    return keyed.withColumn(text_col, changed).select(names)

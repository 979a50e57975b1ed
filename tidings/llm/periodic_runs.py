"""Runs of repeating words: stretches in which words a period apart are equal.

A run has a smallest period q, a length of at least max(6, 4 q) words, and no
neighbouring word that extends it at that period. Periods are handled by
octave, s <= q < 2 s for s = 1, 2, 4, ... Boundaries stand at every s-th word.
Words x with word[x] = word[x + q] form matching intervals, and that of a run
holds at least 3 q of them, so three boundaries at least.

1. A task codes the words of its documents as numbers and looks, for every
   octave, where blocks of s words at two consecutive boundaries repeat q words
   later, by rolling fingerprints. Nothing else can hold a run. Around these
   places it cuts overlapping tiles, whose length follows the octave: of a very
   long document many, of a short one at most one per octave.
2. Tiles are dealt out and solved alone. At every boundary two Z-functions, of
   the words after it and of those before it read backwards, say for all q of
   the octave how far the match reaches to either side, s words at most. This is exact
   and linear, whatever the text repeats.
3. The pieces are shuffled by document and period and stitched where they
   touch. Intervals that are long enough are runs; of those with one start and
   end, the smallest period is the run's, the others are its multiples.

Words are what stands between ``[\\x20\\x09-\\x0D]``, numbered from 0.

Defined cases: a null, empty or blank text has no words and no runs; a very
long text is spread over tiles; equally long runs: the smallest start, then the
smallest period, is the longest run; rows that repeat id and text, or have no
id, are documents of their own; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import U64, mix, slices, text_of
from tidings.session import page_batches, written

LEAST, TIMES = 6, 4
# Words that one tile owns, in a low octave; in a high one eight blocks.
TILE = 8192
STEP = 1_000_000
BASE = np.array(0x9E3779B97F4A7C15, dtype=U64)


class Codes(dict):
    """Numbers of words, given as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def z_function(text: list[int], upto: int) -> list[int]:
    """z[i] for i < upto: how many words from i on equal those from 0 on."""
    n = len(text)
    z = [0] * upto
    left = right = 0
    for i in range(1, upto):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and text[k] == text[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def reach(words: list[int], at: int, s: int) -> list[tuple[int, int, int]]:
    """(q, back, on) for periods s <= q < 2 s: how many words before and from
    ``at`` on equal those q later, at most s. Periods of which neither side
    matches in full are left out: no run needs them here."""
    after = words[at:at + 3 * s]
    on = z_function(after, min(2 * s, len(after)))
    # Read backwards from the boundary, and from the end of each shifted copy.
    before = words[max(at - s, 0):at][::-1]
    ahead = words[at:at + 2 * s][::-1]
    back = z_function(before + [-1] + ahead, len(before) + 1 + len(ahead))
    out = []
    for q in range(s, min(2 * s, len(on))):
        f = min(on[q], s)
        g = min(back[len(before) + 1 + len(ahead) - q], s) if before else 0
        if f == s or g == s:
            out.append((q, g, f))
    return out


def solve(words: list[int], first: int, last: int, s: int) -> Iterator[tuple[int, int, int]]:
    """(q, lo, hi): matching intervals of a tile, pieced together from the
    boundaries first, first + s, ... before ``last``."""
    open_: dict[int, tuple[int, int]] = {}
    for at in range(first, last, s):
        met = {}
        for q, back, on in reach(words, at, s):
            lo = at - back
            if q in open_ and open_[q][1] >= lo:
                lo = open_.pop(q)[0]
            met[q] = (lo, at + on)
        yield from ((q, lo, hi) for q, (lo, hi) in open_.items())
        open_ = met
    yield from ((q, lo, hi) for q, (lo, hi) in open_.items())


def _blocks_of(s: int) -> int:
    """Whole blocks between boundaries that the matches of any run hold."""
    return LEAST - 1 if s == 1 else 2


def places(codes: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(s, boundaries): per octave the boundaries around which a run may lie.
    ``codes`` are documents one after the other, parted by codes of their own."""
    print_ = mix(codes.astype(U64) + U64(1))
    base, s = BASE.reshape(1), 1
    while TIMES * s <= longest:
        if len(print_) < 2 * s:
            return
        block = np.concatenate((print_, np.zeros(-len(print_) % s, dtype=U64))).reshape(-1, s)
        same = block[1:] == block[:-1, :1]
        need = _blocks_of(s)
        together = same[:len(same) - need + 1].copy() if len(same) >= need else same[:0]
        for k in range(1, need):
            together &= same[k:len(same) - need + 1 + k]
        found = np.flatnonzero(together.any(axis=1)) * s
        if len(found):
            yield s, found
        # Fingerprints of twice as many words.
        print_ = print_[:-s] * base + print_[s:]
        base, s = base * base, 2 * s


def tiles(codes: np.ndarray, begin: np.ndarray, size: np.ndarray, tile: int = TILE) -> Iterator[tuple[int, int, np.ndarray, list]]:
    """(document, start, words, octaves): the tiles of a batch, ``start`` in the
    document and octaves (s, first, last boundary + 1) in the tile. Octaves whose
    tiles cover the same words share one. Documents begin at ``begin``."""
    n = int(size.max(initial=0))
    cut: dict[tuple[int, int, int], list] = {}
    for s, found in places(codes, n):
        core = max(tile, 8 * s) // s * s
        doc = np.searchsorted(begin, found, side="right") - 1
        for d in np.unique(doc).tolist():
            lo, hi = int(begin[d]), int(begin[d] + size[d])
            # Where the blocks that were met begin and end.
            near = np.unique(np.concatenate([found[doc == d] // s + k for k in range(_blocks_of(s) + 1)])) * s
            for t in np.unique(near // core).tolist():
                mine = near[near // core == t]
                cut.setdefault((d, core, t), []).append((s, max(int(mine[0]), -(-lo // s) * s), min(int(mine[-1]) + 1, hi)))
    for (d, _, _), octaves in cut.items():
        start = max(min(first - s for s, first, _ in octaves), int(begin[d]))
        end = min(max(last + 3 * s for s, _, last in octaves), int(begin[d] + size[d]))
        yield d, start - int(begin[d]), codes[start:end], [(s, first - start, last - start) for s, first, last in octaves]


def numbers(codes: np.ndarray) -> bytes:
    """Codes as a tile holds them: numbered anew, in as few bytes each as will
    do; the first byte says how many."""
    anew = np.unique(codes, return_inverse=True)[1]
    top = int(anew.max(initial=0))
    kind = np.dtype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")
    return bytes([kind.itemsize]) + anew.astype(kind).tobytes()


def codes_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).tolist()


# ``words`` are joined by spaces and packed.
TILES = ("key long, doc_id long, n long, whole string, words binary, "
         "tiles array<struct<at:long,codes:binary,octaves:array<struct<s:long,first:long,last:long>>>>")


def _tiled(tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        octave = pa.struct([("s", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
        kind = pa.list_(pa.struct([("at", pa.int64()), ("codes", pa.binary()), ("octaves", pa.list_(octave))]))
        pack = zstandard.ZstdCompressor(level=3).compress
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for lo, hi in slices([len(t) for t in texts], STEP):
                words = [t.encode().split() for t in texts[lo:hi]]
                size = np.array([len(w) for w in words], dtype=np.int64)
                number, codes = Codes(), np.zeros(int(size.sum()) + len(words), dtype=np.int64)
                begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
                for i, w, at in zip(range(len(words)), words, begin.tolist()):
                    codes[at:at + len(w)] = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
                    codes[at + len(w)] = -1 - i
                cut: list[list] = [[] for _ in words]
                for d, at, part, octaves in tiles(codes, begin, size, tile):
                    cut[d].append({"at": at, "codes": numbers(part), "octaves": [dict(zip(("s", "first", "last"), o)) for o in octaves]})
                joined = [b" ".join(w) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(key, key + len(words)), pa.int64()), pa.array(ids[lo:hi], pa.int64()), pa.array(size, pa.int64()),
                     pa.array([hashlib.sha256(w).hexdigest() for w in joined], pa.string()),
                     pa.array([pack(w) if c else None for w, c in zip(joined, cut)], pa.binary()),
                     pa.array(cut, kind)], names=["key", "doc_id", "n", "whole", "words", "tiles"])
                key += len(words)
    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            words = codes_of(row["codes"])
            out += [(row["key"], q, row["at"] + lo, row["at"] + hi) for o in row["octaves"]
                    for q, lo, hi in solve(words, o["first"], o["last"], o["s"])]
        found = np.array(out, dtype=np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(4)], names=["key", "q", "lo", "hi"])


def tiled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(key, doc_id, n, whole, words, tiles) of every document, written once;
    ``whole`` is the digest of all words, and ``words`` is null without tiles."""
    page_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return written(rows.mapInArrow(_tiled(tile), TILES), "tiles")


def stitched(table: DataFrame) -> DataFrame:
    """(key, start, length, period): all runs of the documents in ``tiled``."""
    spark = table.sparkSession
    tile = table.where(F.size("tiles") > 0).select("key", F.explode("tiles").alias("t")).select("key", "t.*")
    dealt = tile.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "at")
    part = dealt.mapInArrow(_solved, "key long, q long, lo long, hi long")
    # Sorted pieces of one document and period; those that touch become one.
    order = Window.partitionBy("key", "q").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = part.withColumn("new", F.when(before >= F.col("lo"), 0).otherwise(1))
    joined = apart.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    one = joined.groupBy("key", "q", "part").agg(F.min("lo").alias("start"), F.max("hi").alias("end"))
    long_ = one.select("key", "q", "start", (F.col("end") - F.col("start") + F.col("q")).alias("length")).where(
        F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("q")))
    return long_.groupBy("key", "start", "length").agg(F.min("q").alias("period"))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        unpack = zstandard.ZstdDecompressor().decompress
        for packed, runs in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist()):
            words = unpack(packed).split(b" ")
            drop = np.zeros(len(words) + 1, dtype=np.int64)
            for r in runs:
                drop[r["start"] + r["period"]] += 1
                drop[r["start"] + r["length"]] -= 1
            gone = np.cumsum(drop)
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode())
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(kept, pa.string())], names=["key", "collapsed"])


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(key, doc_id, n, whole, runs, collapsed) per document: its runs by start and
    period, and its text without what repeats, null where nothing does."""
    table = tiled(docs, id_col, text_col, tile)
    found = (stitched(table).groupBy("key")
             .agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs")))
    # Starts are distinct but for runs of several periods from one word.
    found = written(found.withColumn("runs", F.array_sort("runs", lambda x, y: F.when(x.start != y.start, F.signum(x.start - y.start).cast("int"))
                                                          .otherwise(F.signum(x.period - y.period).cast("int")))), "runs")
    texts = table.where(F.size("tiles") > 0).select("key", "words").join(found, "key")
    cut = texts.mapInArrow(_collapsed, "key long, collapsed string")
    return (table.select("key", "doc_id", "n", "whole").join(found, "key", "left").join(cut, "key", "left")
            .withColumn("runs", F.coalesce("runs", F.expr("cast(array() as array<struct<start:bigint,length:bigint,period:bigint>>)"))))


def digest(found: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run, digests."""
    best = F.get(F.array_sort("runs", lambda x, y: F.when(x.length != y.length, F.signum(y.length - x.length).cast("int"))
                              .when(x.start != y.start, F.signum(x.start - y.start).cast("int"))
                              .otherwise(F.signum(x.period - y.period).cast("int"))), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "whole", "collapsed",
                       F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"))
    return out.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                      F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                      F.sha2("lines", 256).alias("runs_sha256"),
                      F.coalesce(F.sha2("collapsed", 256), "whole").alias("collapsed_sha256"))


def planted(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text in which, for every tenth document by the checksum of its id,
    words from some place on repeat; a null id changes nothing."""
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(
            F.get(words, (a + (i - a) % p).cast("int")))), " ")

    split = F.filter(F.split(text_col, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    changed = F.get(F.transform(F.array(split), lambda words: F.when(F.size(words) > 0, repeat(words)).otherwise("")), F.lit(0))
    return F.when(h % 10 == 0, changed).otherwise(F.col(text_col))

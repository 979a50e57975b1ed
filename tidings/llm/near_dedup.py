"""Near duplicates: fast similarity sketches, banding, exact verification.

A sketch has ``bands * rows`` coordinates. In each round every shingle is
hashed to one coordinate and leaves a value there; a coordinate keeps its
smallest value of the first round that reached it. Rounds go on until every
coordinate is filled; after as many rounds as there are coordinates, one round
per coordinate fills what is left, so none stays empty. The cost is a few
rounds over the set instead of one hash per coordinate, and the estimate
concentrates at least as well as independent minima.

Documents with equal sets are one class, so groups of copies take no part in
banding. Members of a band's bucket are tried with the bucket's smallest and
largest class, on full sets. Where a bucket still holds several components,
its classes are joined on prefixes (similar sets share one of their rarest
shingles) and what that finds between components is verified. Inside the join
a pair must pass two bounds that no similar pair fails: one on the places of
the shared shingle, one on the shingles that only one of both sets holds. For
the second every set carries a bitmap with the parity of its shingles at each
of 512 places: two bitmaps differ in no more places than there are such
shingles. So of every pair
in a bucket it is known that the two are similar, in one component, or not
similar, though the pairs of a large group are never formed. The bitmap tells
sets of up to some 1,500 shingles apart; for longer ones the other bound remains.
With 24 bands of 4 a pair at a similarity of 0.85 misses all bands with a
probability of 2e-8.

Sets hold 64-bit hashes of whole shingles. Defined cases: null or blank texts
have an empty set and link with nothing; very long texts are read whole; of
equal sets the smallest key counts; a null id ranks below every id; rows
that repeat id and text are one document; an empty table gives no rows; other
columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import U64, digest_of, id_of, keep_rows, key_of, mix, slices, text_of
from tidings.llm.components import components
from tidings.session import page_batches, written

BANDS, ROWS = 24, 4
# Bytes of text that one numpy step works on.
STEP = 2_000_000
# Longs of a set's bitmap.
LONGS = 8
_EMPTY = np.iinfo(np.uint64).max


def shingles(text: bytes, width: int) -> np.ndarray:
    """Distinct hashes of the shingles of ``width`` words: A-Z lower-cased,
    words between ASCII white space; fewer words are one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=U64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U64, count=len(words))
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, n, dtype=U64)
    for i in range(n):
        out = out * U64(0x9E3779B97F4A7C15) + mix(h[i:len(h) - n + 1 + i] + U64(i))
    return np.unique(mix(out))


def sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """The sketch of every non-empty set, one row each."""
    t = coordinates
    out = np.full((len(sets), t), _EMPTY, dtype=U64)
    flat = out.reshape(-1)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    live = np.arange(len(sets))
    values = np.concatenate(sets) if sets else np.zeros(0, dtype=U64)
    owner = np.repeat(live, size)
    for i in range(2 * t):
        if not len(live):
            break
        x = mix(values ^ mix(np.full(1, i + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)))
        if i < t:
            place = (((x >> U64(32)) * U64(t)) >> U64(32)).astype(np.int64)
        else:
            place = np.full(len(x), i - t, dtype=np.int64)
        v = (U64(i) << U64(32)) | (x & U64(0xFFFFFFFF))
        np.minimum.at(flat, owner * t + place, v)
        full = (out[live] != U64(_EMPTY)).all(axis=1)
        if full.any():
            live = live[~full]
            open_ = np.zeros(len(sets), dtype=bool)
            open_[live] = True
            mask = open_[owner]
            values, owner = values[mask], owner[mask]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of every sketch."""
    part = sketch.reshape(-1, bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), part.shape[:2]).copy()
    for r in range(rows):
        out = mix(out * U64(0x9E3779B97F4A7C15) + part[:, :, r])
    return out.view(np.int64)


def _sign(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            sizes = pa.compute.binary_length(texts).to_pylist()
            for lo, hi in slices(sizes, STEP):
                sets = [shingles(t.as_py(), width) for t in texts.slice(lo, hi - lo)]
                keys = np.zeros((len(sets), bands), dtype=np.int64)
                some = [i for i, s in enumerate(sets) if len(s)]
                if some:
                    keys[some] = band_keys(sketches([sets[i] for i in some], bands * rows), bands, rows)
                ends = np.cumsum([0] + [bands if len(s) else 0 for s in sets]).astype(np.int32)
                kept = keys[some].reshape(-1) if some else np.zeros(0, dtype=np.int64)
                names = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(lo, hi - lo), batch.column("digest").slice(lo, hi - lo),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(kept))],
                    names=["key", "digest", "n", "class", "bands"])
    return run


def bitmap(values: np.ndarray) -> np.ndarray:
    """For each of ``64 * LONGS`` places, whether an odd number of shingles is there."""
    place = ((values >> U64(32)) * U64(64 * LONGS)) >> U64(32)
    odd = (np.bincount(place.astype(np.int64), minlength=64 * LONGS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            sizes = pa.compute.binary_length(texts).to_pylist()
            for lo, hi in slices(sizes, STEP):
                sets = [shingles(t.as_py(), width) for t in texts.slice(lo, hi - lo)]
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                bits = np.concatenate([bitmap(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * LONGS), pa.array(bits))],
                    names=["class", "set", "bits"])
    return run


def signatures(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, digest, n, class, bands) of every row, written once."""
    page_batches(docs.sparkSession)
    source = docs.select(key_of(id_col).alias("key"), digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))
    return written(source.mapInArrow(_sign(width, bands, rows),
                                     "key long, digest binary, n long, class binary, bands array<long>"), "signatures")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("b"), F.col("set").alias("sb"))
    right = sets.select(F.col("class").alias("a"), F.col("set").alias("sa"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "b").join(right, "a").where(both * 100 >= union * percent).select("a", "b")


def _prefix_pairs(left: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that can be similar, from (class, n,
    label, set, bits): similar sets share one of their rarest shingles, so many
    as may be missing plus one, and fewer in the smaller set. Shingles found
    under one label only are left out before the join, so pairs inside a
    component are never formed."""
    words = written(left.select("class", "n", "label", F.explode("set").alias("w")), "words")
    count = words.groupBy("w").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    order = F.row_number().over(Window.partitionBy("class").orderBy("df", "w"))
    need = F.expr(f"n - (n * {percent} + 99) div 100 + 1")
    fewer = F.expr(f"n - (n * {2 * percent} + {99 + percent}) div {100 + percent} + 1")
    prefix = (words.join(count, "w").withColumn("at", order).where(F.col("at") <= need).where("lo <> hi")
              .select("w", "class", "n", "label", "at").join(left.select("class", "bits"), "class"))
    prefix = written(prefix, "prefixes")
    a = prefix.select("w", F.col("class").alias("a"), F.col("n").alias("m"), F.col("label").alias("la"), F.col("at").alias("i"),
                      F.col("bits").alias("p"))
    b = prefix.where(F.col("at") <= fewer).select("w", F.col("class").alias("b"), "n", F.col("label").alias("lb"),
                                                  F.col("at").alias("j"), F.col("bits").alias("q"))
    smaller = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("b") < F.col("a")))
    # If this is the first shingle they share, the rest must still suffice.
    near = (F.least(F.col("m") - F.col("i"), F.col("n") - F.col("j")) + 1) * (100 + percent) >= (F.col("m") + F.col("n")) * percent
    apart = sum((F.bit_count(F.col("p")[k].bitwiseXOR(F.col("q")[k])) for k in range(LONGS)), F.lit(0))
    alike = apart * (100 + percent) <= (F.col("m") + F.col("n")) * (100 - percent)
    return a.join(b, (a["w"] == b["w"]) & (F.col("la") != F.col("lb")) & smaller & near & alike).select("a", "b").distinct()


def classes_of(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, digest, n, component) for every row; ``component`` is the smallest
    key reachable over links of at least ``percent`` per cent similarity."""
    signed = signatures(docs, width, bands, rows, id_col, text_col)
    groups = written(signed.where("class is not null").groupBy("class").agg(
        F.min(F.struct("key", "digest", "n", "bands")).alias("g")).select("class", "g.*"), "classes")
    placed = groups.select("class", "n", F.explode("bands").alias("h"))
    shared = placed.groupBy("h").agg(F.min("class").alias("rep"), F.max("class").alias("last")).where("rep <> last")
    members = written(placed.join(shared, "h"), "buckets")

    size = members.select("class", "n").distinct()
    alike = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    ends = F.explode(F.array("rep", "last")).alias("a")
    star = (members.select(ends, F.col("class").alias("b"), "n").where("a <> b").distinct()
            .join(size.select(F.col("class").alias("a"), F.col("n").alias("m")), "a")
            .where(alike(F.col("n"), F.col("m"))).select("a", "b"))
    needed = groups.select("class", "key", "digest").join(size.select("class"), "class", "left_semi")
    texts = (docs.select(key_of(id_col).alias("key"), digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))
             .join(needed, ["key", "digest"]).select("class", "text"))
    # Rows that repeat id and text stand in one class, which has one set.
    texts = texts.groupBy("class").agg(F.first("text").alias("text"))
    sets = written(texts.mapInArrow(_sets(width), "class binary, set array<long>, bits array<long>"), "sets")
    links = written(_verified(star, sets, percent), "links")
    label = components(links, "a", "b")

    # What is left: classes in buckets that hold more than one component.
    labelled = written(members.join(label.withColumnRenamed("node", "class"), "class", "left")
                       .select("h", "class", "n", F.coalesce("label", "class").alias("label")), "labelled")
    mixed = labelled.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("h")
    rest = labelled.join(mixed, "h", "left_semi").select("class", "n", "label").distinct()
    cross = _prefix_pairs(sets.join(rest, "class"), percent)
    more = written(_verified(cross, sets, percent), "links")
    final = components(links.unionByName(more), "a", "b")

    named = groups.select("class", "key").join(final.withColumnRenamed("node", "class"), "class", "left")
    named = named.select("class", "key", F.coalesce("label", "class").alias("label"))
    least = named.groupBy("label").agg(F.min("key").alias("component"))
    component = named.join(least, "label").select("class", "component")
    alone = signed.where("class is null").select("key", "digest", "n", F.col("key").alias("component"))
    return signed.where("class is not null").join(component, "class").select("key", "digest", "n", "component").unionByName(alone)


def decisions(docs: DataFrame, width: int = 5, percent: int = 80, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return classes_of(docs, width, percent, **options).select(
        id_of("key").alias("doc_id"), F.col("n").alias("n_shingles"), id_of("component").alias("component_id"),
        (F.col("key") == F.col("component")).alias("kept"))


def survivors(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
              **options) -> DataFrame:
    """One document of each component, with all its columns. Documents of one
    id and component but several texts are told apart by their digest."""
    found = classes_of(docs, width, percent, id_col=id_col, text_col=text_col, **options).where("key = component")
    rows = found.groupBy("key", "digest").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
    blank = rows.where("n = 0").select("key", "digest", "rows")
    first = (rows.where("n > 0").groupBy("key").agg(F.min(F.struct("digest", "rows")).alias("r"))
             .select("key", "r.digest", "r.rows"))
    return keep_rows(docs, first.unionByName(blank), id_col, text_col)

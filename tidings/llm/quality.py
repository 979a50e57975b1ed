"""Document quality from random-indexing word vectors and a small network.

Every word has a fixed random index vector (a few +1 and -1, by a hash). A
word's vector is the sum of its neighbours' index vectors over all texts given
to ``fit``, with or without label, scaled to length one; words are hashed to ``SLOTS`` slots. A document is
the mean of its words' vectors, and a two-layer network (numpy) turns that into
a logit, whose temperature is fitted on labelled documents the network has not
seen. Besides words, their shapes (capitals, digits, signs) and repetitions are
words of their own.

Only the network is fitted on a sample: at most about ``fit_rows`` labelled
documents, drawn by a hash of the id. Word vectors are summed in every task and
then over ``FAN`` tasks at a time, level by level; they are whole numbers below
2**53, so their order does not matter. Only one matrix of fixed size and the
drawn documents' means reach the driver.

Defined cases: a null or blank text has a zero vector and still gets a score;
a text of any length is read whole, in parts that share ``WINDOW`` words; repeated
rows count as often as they stand there, and equal texts get equal scores;
null labels and labels without a document are ignored; several labels of one
document count as the largest; without any labels every score is 0.5; an empty
table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import slices, text_of
from tidings.session import written

SLOTS = 1 << 14
DIM = 64
NONZERO = 6
WINDOW = 2
FIT_ROWS = 20_000
HIDDEN = 32
STEP = 250_000
REMEMBER = 200_000
PARTS = 16
FAN = 64
CHUNKS = 500_000
PAIRS = 1_000_000
WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
AGAIN = "<again>"


def words(chunk: str) -> list[str]:
    """The words of a chunk between white space, and their shapes."""
    found = (chunk,) if chunk.isalpha() else WORD.findall(chunk)
    return list(chain.from_iterable((w, shape(w)) for w in found))


def shape(word: str) -> str:
    if word.isupper() and len(word) > 1:
        return "<upper>"
    first = word[0]
    if first.isalpha():
        return "<title>" if first.isupper() else "<lower>"
    return "<title>" if first.isupper() else "<number>" if first.isdigit() else "<sign>"


def slot(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) % SLOTS


SHAPES = {s: slot(s) for s in ("<upper>", "<title>", "<lower>", "<number>", "<sign>")}


def slots_of(chunk: str) -> list[int]:
    """The slots of ``words(chunk)``."""
    out = []
    for w in (chunk,) if chunk.isalpha() else WORD.findall(chunk):
        out += (xxhash.xxh3_64_intdigest(w) % SLOTS, SHAPES[shape(w)])
    return out


def slots_in(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``slots_of`` every chunk, one after the other, and how many each has."""
    found = [(c,) if c.isalpha() else WORD.findall(c) for c in chunks]
    size = np.fromiter(map(len, found), np.int64, len(found))
    flat, lower = list(chain.from_iterable(found)), SHAPES["<lower>"]
    out = np.empty((len(flat), 2), dtype=np.int64)
    out[:, 0] = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat)) % SLOTS
    # Most words are lower-case letters.
    out[:, 1] = [lower if w.islower() and w.isalpha() else SHAPES[shape(w)] for w in flat]
    return out.reshape(-1), 2 * size


class Numbers(dict):
    """Numbers of chunks from 0 on, given as they are met."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


def index_vectors() -> np.ndarray:
    draw = np.random.default_rng(7)
    out = np.zeros((SLOTS, DIM), dtype=np.float32)
    place = draw.integers(0, DIM, size=(SLOTS, NONZERO))
    sign = draw.integers(0, 2, size=(SLOTS, NONZERO)) * 2 - 1
    np.add.at(out, (np.arange(SLOTS)[:, None], place), sign)
    return out


def entries(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of every index vector's entries other than zero, as many columns
    as the fullest one has."""
    there = index != 0
    place = np.argsort(~there, axis=1, kind="stable")[:, :max(1, there.sum(axis=1).max())]
    return place, np.take_along_axis(index, place, axis=1).astype(np.float64)


def sums_of(vectors: np.ndarray, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per row the sum of ``size`` vectors, named one after the other in ``flat``. Rows of
    equal size are added at once: most are of two vectors, a word's and its shape's."""
    out = np.zeros((len(size), vectors.shape[1]), dtype=np.float32)
    start = np.cumsum(size) - size
    for k in range(1, 9):
        at = start[rows] if len(rows := np.flatnonzero(size == k)) else []
        if len(at):
            rest = sum((vectors[flat[at + j]] for j in range(2, k)), vectors[flat[at + 1]]) if k > 1 else 0
            out[rows] = vectors[flat[at]] + rest
    if len(rows := np.flatnonzero(size > 8)):
        ends = np.repeat(size > 8, size)
        out[rows] = np.add.reduceat(vectors[flat[ends]], np.cumsum(size[rows]) - size[rows])
    return out


class Pooler:
    """Sums of word vectors of documents; chunks are looked up once. A column of
    ``sums`` belongs to a chunk: gathered and added along rows, numbers stay side by side."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.again = vectors[slot(AGAIN)]
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.sums = np.zeros((self.vectors.shape[1], 0), dtype=np.float32)
        self.counts = np.zeros(0, dtype=np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Sums of chunks, the next that have a number."""
        flat, size = slots_in(chunks)
        have, need = len(self.counts), len(self.counts) + len(chunks)
        if need > self.sums.shape[1]:
            more = np.empty((len(self.sums), max(have, len(chunks))), dtype=np.float32)
            self.sums = np.concatenate((self.sums[:, :have], more), axis=1)
        self.sums[:, have:need] = sums_of(self.vectors, flat, size).T
        self.counts = np.concatenate((self.counts, size))

    def means(self, texts: list[str]) -> np.ndarray:
        """The mean vector of every text, zero without words."""
        if len(self.number) > REMEMBER:
            self.forget()
        split = [t.split() for t in texts]
        flat = list(chain.from_iterable(split))
        n = np.fromiter(map(self.number.__getitem__, flat), dtype=np.int64, count=len(flat))
        if len(self.number) > len(self.counts):
            self.learn(list(islice(self.number, len(self.counts), None)))
        size = np.array([len(s) for s in split])
        out = np.zeros((len(texts), self.vectors.shape[1]), dtype=np.float32)
        some = size > 0
        if not some.any():
            return out
        owner = np.repeat(np.arange(len(texts)), size)
        again = np.zeros(len(n), dtype=np.int64)
        again[1:] = (n[1:] == n[:-1]) & (owner[1:] == owner[:-1])
        start = np.concatenate(([0], np.cumsum(size[some])[:-1]))
        total = np.add.reduceat(self.sums.take(n, axis=1), start, axis=1).T
        repeated = np.add.reduceat(again, start)
        count = np.add.reduceat(self.counts[n], start) + repeated
        out[some] = (total + repeated[:, None] * self.again) / np.maximum(count, 1)[:, None]
        return out


@dataclass
class Model:
    vectors: np.ndarray
    layers: list[np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, rate: float = 0.01, seed: int = 3):
    """Two layers by Adam on the log loss with a small weight decay."""
    draw = np.random.default_rng(seed)
    layers = [draw.normal(size=(x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
              draw.normal(size=hidden) / np.sqrt(hidden), np.zeros(1)]
    first, second, t = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(epochs):
        order = draw.permutation(len(x))
        for lo in range(0, len(x), 256):
            i = order[lo:lo + 256]
            h = np.tanh(x[i] @ layers[0] + layers[1])
            z = h @ layers[2] + layers[3]
            g = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[i]) / len(i)
            back = np.outer(g, layers[2]) * (1 - h * h)
            grads = [x[i].T @ back + 1e-4 * layers[0], back.sum(axis=0), h.T @ g + 1e-4 * layers[2], g.sum(keepdims=True)]
            t += 1
            for w, grad, m, v in zip(layers, grads, first, second):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return layers


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, by a search over a grid."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(20), 200))
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def _add_contexts(total: np.ndarray, index: np.ndarray, n: np.ndarray, done: int) -> None:
    """Add the index vectors of all words up to ``WINDOW`` apart, where the later one
    stands at ``done`` or after; ``SLOTS`` is no word. Equal pairs are counted first, and
    only the few entries of a vector that are not zero are added."""
    codes = []
    for d in range(1, WINDOW + 1):
        first = max(d, done)
        a, b = n[first:], n[first - d:len(n) - d]
        codes.append((np.minimum(a, b) * SLOTS + np.maximum(a, b))[(a < SLOTS) & (b < SLOTS)])
    codes = np.sort(np.concatenate(codes).astype(np.uint32))
    if not len(codes):
        return
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    times = np.diff(np.append(first, len(codes))).astype(np.float64)
    low, high = np.divmod(codes[first].astype(np.int64), SLOTS)
    place, value = entries(index)
    for word, near in ((low, high), (high, low)):
        for lo in range(0, len(word), PAIRS):
            row, other, often = word[lo:lo + PAIRS] * DIM, near[lo:lo + PAIRS], times[lo:lo + PAIRS]
            for j in range(place.shape[1]):
                total += np.bincount(row + place[other, j], value[other, j] * often, SLOTS * DIM).reshape(SLOTS, DIM)


class Chunks:
    """Slots of texts, the chunks between white space looked up once."""

    def __init__(self):
        self.number = Numbers({"": 0})
        self.slots, self.start = np.full(WINDOW, SLOTS, dtype=np.int64), np.array([0, WINDOW], dtype=np.int64)

    def row(self, chunks: list[str], before: str) -> np.ndarray:
        """The slots of consecutive chunks that follow ``before``; '' ends a text."""
        if len(self.number) > REMEMBER:
            self.__init__()
        n = np.fromiter(map(self.number.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        known = len(self.start) - 1
        if len(self.number) > known:
            flat, more = slots_in(list(islice(self.number, known, None)))
            self.slots = np.concatenate((self.slots, flat))
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(more)))
        size = self.start[n + 1] - self.start[n]
        # A chunk that follows itself has one more word.
        again = np.concatenate(([chunks[0] == before], n[1:] == n[:-1])) & (size > 0) & (self.slots[self.start[n]] < SLOTS)
        end = np.cumsum(size + again)
        out, own = np.full(end[-1], slot(AGAIN), dtype=np.int64), np.ones(end[-1], dtype=bool)
        own[end[again] - 1] = False
        place = np.repeat(self.start[n] - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        out[own] = self.slots[place]
        return out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, total, known = index_vectors(), np.zeros((SLOTS, DIM)), Chunks()
    held, done, before = [], np.zeros(0, dtype=np.int64), ""

    def add(chunks: list[str]) -> tuple[np.ndarray, str]:
        row = np.concatenate((done, known.row(chunks, before)))
        _add_contexts(total, index, row, len(done))
        return row[-WINDOW:], chunks[-1]

    for batch in batches:
        for text in batch.column("text").to_pylist():
            held += text.split()
            held.append("")  # no chunk: no word of one text is a neighbour in the next
            while len(held) > CHUNKS:
                (done, before), held = add(held[:CHUNKS]), held[CHUNKS:]
    if held:
        add(held)
    # Parts of fixed size at most; slots without a word stay out.
    met = np.flatnonzero(total.any(axis=1))
    part = met * PARTS // SLOTS
    there = np.unique(part)
    task = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [pa.array(there, pa.int32()), pa.array([task] * len(there), pa.int32()),
         pa.array([met[part == p].astype(np.int32).tobytes() for p in there], pa.binary()),
         pa.array([total[met[part == p]].tobytes() for p in there], pa.binary())],
        names=["part", "task", "slots", "sums"])


SUMS = "part int, task int, slots binary, sums binary"


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    size, first = SLOTS // PARTS, int(frame["part"].iloc[0]) * SLOTS // PARTS
    total = np.zeros((size, DIM))
    for slots, sums in zip(frame["slots"], frame["sums"]):
        total[np.frombuffer(slots, dtype=np.int32) - first] += np.frombuffer(sums).reshape(-1, DIM)
    met = np.flatnonzero(total.any(axis=1))
    return pd.DataFrame({"part": frame["part"].iloc[:1], "task": frame["task"].iloc[:1],
                         "slots": [(met + first).astype(np.int32).tobytes()], "sums": [total[met].tobytes()]})


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The vectors of all slots from the column ``text`` of all rows."""
    sums = written(texts.select("text").mapInArrow(_contexts, SUMS), "contexts")
    tasks = sums.agg(F.max("task")).first()[0]
    while tasks:
        tasks //= FAN
        sums = sums.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).groupBy("part", "task").applyInPandas(_add, SUMS)
    vectors = np.zeros((SLOTS, DIM))
    for r in sums.collect():
        vectors[np.frombuffer(r["slots"], dtype=np.int32)] = np.frombuffer(r["sums"]).reshape(-1, DIM)
    # The common direction of all contexts says nothing; then length one.
    vectors -= vectors.sum(axis=0) / max(1.0, np.abs(vectors).sum()) * np.abs(vectors).sum(axis=1, keepdims=True)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)).astype(np.float32)


def _means(vectors, text_col: str) -> Column:
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pooler = Pooler(vectors.value)
        for texts in batches:
            out = []
            for lo, hi in slices([len(t) for t in texts], STEP):
                out += [x.tobytes() for x in pooler.means(list(texts[lo:hi]))]
            yield pd.Series(out, dtype=object)
    return run(F.col(text_col))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> Model:
    """A model of ``labels.quality`` from the labelled documents in ``docs``, and of the
    words of all of them."""
    spark = docs.sparkSession
    named = labels.select(F.col("doc_id").alias("id"), "quality").where("id is not null and quality in (0, 1)")
    named = named.groupBy("id").agg(F.max("quality").alias("quality"))
    count = named.count()
    share = min(1.0, fit_rows / count) if count else 0.0
    drawn = lambda c: F.pmod(F.xxhash64(F.lit("quality"), c), F.lit(1_000_000)) < share * 1_000_000
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    vectors = word_vectors(texts)
    sample = written(texts.where(drawn("id")).join(named.where(drawn("id")), "id").repartition(12), "labelled")
    pooled = sample.withColumn("x", _means(spark.sparkContext.broadcast(vectors), "text")).select("id", "quality", "x").toPandas()
    pooled = pooled.sort_values("id")
    zero, one = np.zeros(DIM), np.ones(DIM)
    if not len(pooled):
        return Model(vectors, [np.zeros((DIM, 1)), np.zeros(1), np.zeros(1), np.zeros(1)], zero, one, 1.0)
    x = np.array([np.frombuffer(b, dtype=np.float32) for b in pooled["x"]]).astype(np.float64)
    y = pooled["quality"].to_numpy(dtype=np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    apart = np.arange(len(x)) % 5 == 0 if len(x) >= 20 else np.zeros(len(x), dtype=bool)
    model = Model(vectors, train(((x - mean) / scale)[~apart], y[~apart]), mean, scale, 1.0)
    if apart.any():
        model.temperature = temperature(model.logits(x[apart]), y[apart])
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from fitting: crc32 of its id mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scorer(model: Model, spark, text_col: str = "text") -> Column:
    """The probability that a text is of quality 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pooler = Pooler(shared.value.vectors)
        for texts in batches:
            out = [np.zeros(0)]
            for lo, hi in slices([len(t) for t in texts], STEP):
                out.append(shared.value.scores(pooler.means(list(texts[lo:hi])).astype(np.float64)))
            yield pd.Series(np.concatenate(out))
    return run.asNondeterministic()(text_of(text_col))


def scores(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.select("doc_id", held_out("doc_id").alias("held_out"), scorer(model, docs.sparkSession).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

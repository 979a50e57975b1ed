"""Best-fit decreasing packing of token pieces into sequences of fixed length.

Pieces are taken by decreasing length; each goes to the open sequence with the
least room that still holds it, found in a segment tree over the remaining
capacities, and to a new sequence when none does. Where a piece goes depends
on lengths alone, and pieces of one length are alike. So the plan is made over
the histogram of lengths (as many numbers as a sequence has tokens, however
large the corpus): all pieces of a length that meet sequences of the same room
are placed in one step, as one-by-one placement would place them. The pieces
are then numbered within their length, in blocks that bound what a task holds,
and matched to the plan's steps.

Defined cases: a null or empty text has no ids and no piece; a text longer
than a sequence is cut into full pieces and one shorter rest; repeated rows
are packed each on its own; ties take any order; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import slices, text_of
from tidings.session import written

SIZE = 2048
STEP = 2_000_000
# Pieces of one length that one task numbers at once.
BLOCK = 250_000
# Chunks and words whose ids a worker remembers.
REMEMBER = 500_000
# A chunk of signs, letters, signs: the tokenizer's pattern cuts it there, as
# no apostrophe or digit is in it, and its form is already composed.
_SIGN = r"[!-&(-/:-@\[-`{-~]*"
PLAIN = re.compile(f"({_SIGN})([A-Za-zÀ-ÖØ-öø-ÿ]+)({_SIGN})").fullmatch


class Room:
    """A segment tree over remaining capacities: which hold an open sequence."""

    def __init__(self, size: int):
        self.n = 1 << size.bit_length()
        self.some = bytearray(2 * self.n)

    def set(self, room: int, some: bool) -> None:
        i = self.n + room
        self.some[i] = some
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] | self.some[2 * i + 1]

    def tightest(self, need: int) -> int:
        """The least capacity of at least ``need`` that is open, or -1."""
        i = self.n + need
        if self.some[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return -1
        while i < self.n:
            i = 2 * i if self.some[2 * i] else 2 * i + 1
        return i - self.n


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first, last, sequence, per, offset): the pieces numbered
    first <= r < last of that length go, ``per`` to a sequence, to sequences
    sequence, sequence + 1, ... from ``offset`` on."""
    room, steps, opened = Room(size), [], 0
    runs: list[deque] = [deque() for _ in range(size + 1)]

    def put(left: int, first: int, many: int) -> None:
        if many and left:
            runs[left].append((first, many))
            room.set(left, True)

    for length in sorted(histogram, reverse=True):
        todo, at = histogram[length], 0
        while todo:
            left = room.tightest(length)
            if left < 0:
                left, first = size, opened
                many = -(-todo // (size // length))
                opened += many
            else:
                first, many = runs[left].popleft()
                if not runs[left]:
                    room.set(left, False)
            per = left // length
            full = min(many, todo // per)
            if full:
                steps.append((length, at, at + full * per, first, per, size - left))
                put(left - per * length, first, full)
                at, todo = at + full * per, todo - full * per
            if full < many and 0 < todo < per:
                steps.append((length, at, at + todo, first + full, per, size - left))
                put(left - todo * length, first + full, 1)
                full, at, todo = full + 1, at + todo, 0
            put(left, first + full, many - full)
    return steps


class Encoder:
    """Ids of texts. The tokenizer drops white space and never looks across
    it, so the chunks between are encoded once and remembered. A chunk of plain
    letters between plain signs is made of at most three words, remembered
    too. Texts that hold a control character which Python and the tokenizer
    read differently, or a special token's brackets, are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        # How the tokenizer writes each byte of a two-byte letter.
        self.bytes = {b: c for letter in map(chr, range(0xC0, 0x100))
                      for b, c in zip(letter.encode(), level.pre_tokenize_str(letter)[0][0])}
        self.words: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint32)
        self.start = np.zeros(1, dtype=np.int64)

    def learn_words(self, words: list[str]) -> None:
        """Lower-cased letters or signs alone are one piece to the tokenizer;
        its model takes them as a string of one character per byte."""
        for word in words:
            plain = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes)
            self.words[word] = array("I", [token.id for token in self.model.tokenize(plain)]).tobytes()

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of whole chunks."""
        out = []
        for lo in range(0, len(chunks), 4000):
            part = chunks[lo:lo + 4000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begin = np.cumsum([len(c) + 1 for c in part])
            at = np.fromiter((o[0] for o in e.offsets), dtype=np.int64, count=len(e.ids))
            ends, ids = (4 * np.searchsorted(at, begin)).tolist(), array("I", e.ids).tobytes()
            out += [ids[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def learn(self, chunks: list[str]) -> None:
        if len(self.words) > REMEMBER:
            self.words = {}
        match = [m and m.groups() for m in map(PLAIN, chunks)]
        words = self.words
        words.setdefault("", b"")
        split = [m and (m[0], m[1].lower(), m[2]) for m in match]
        self.learn_words(list({w for s in split if s for w in s if w not in words}))
        odd = iter(self.encode_chunks([c for c, s in zip(chunks, split) if not s]))
        found = [words[s[0]] + words[s[1]] + words[s[2]] if s else next(odd) for s in split]
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(found), dtype=np.uint32)))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum([len(f) // 4 for f in found])))
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks))))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = ["<|" in t or any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        split = [[] if w else t.split() for w, t in zip(whole, texts)]
        if len(self.number) > REMEMBER:
            self.forget()
        flat = list(chain.from_iterable(split))
        number = list(map(self.number.get, flat, repeat(-1)))
        n = np.array(number, dtype=np.int64)
        fresh = np.flatnonzero(n < 0).tolist()
        if fresh:
            self.learn(list(dict.fromkeys(flat[i] for i in fresh)))
            n[fresh] = [self.number[flat[i]] for i in fresh]
        start, size = self.start[n], self.start[n + 1] - self.start[n]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate(([0], ends))
        at = 0
        for text, chunks, alone in zip(texts, split, whole):
            if alone:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            else:
                yield ids[ends[at]:ends[at + len(chunks)]]
                at += len(chunks)


_encoders: dict[str, Encoder] = {}


def _pieces(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for lo, hi in slices([len(t) for t in texts], STEP):
                row, piece, length, crc = [], [], [], []
                for i, found in enumerate(encoder.encode(texts[lo:hi]), lo):
                    found = np.append(found, np.uint32(end_id)).astype("<u4")
                    for k in range(0, len(found), size):
                        part = found[k:k + size]
                        row.append(i)
                        piece.append(k // size)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                at = np.array(piece, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), pa.array(at.astype(np.int32)), pa.array(at * size),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of every document: its ids, then ``end_id``, cut at
    ``size``. ``tokenizer`` is a file that every executor can open."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_pieces(tokenizer, end_id, size),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """``parts`` (with ``length``) and each piece's sequence_id and offset."""
    spark = parts.sparkSession
    names = parts.columns
    rows = written(parts, "pieces")
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    blocks = max(16, max(histogram.values(), default=0) // BLOCK)
    numbered = rows.withColumn("_block", F.pmod(F.xxhash64(*names), F.lit(blocks)))
    # Where each block of a length starts: a running sum of counts.
    count = numbered.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("length", "_block").orderBy(*[c for c in names if c != "length"]))
    ranked = (numbered.withColumn("_rank", rank - 1).join(base, ["length", "_block"])
              .withColumn("_rank", F.col("_base") + F.col("_rank")))
    # One row per length, its steps in order of their pieces: at most as many
    # rows as a sequence has tokens.
    per: dict[int, list] = {}
    for length, first, last, sequence, each, offset in plan(histogram, size):
        per.setdefault(length, []).append((first, sequence, each, offset))
    steps = spark.createDataFrame([(k, v) for k, v in per.items()],
                                  "length long, steps array<struct<first:long,sequence:long,each:long,offset:long>>")
    split = steps.select("length", F.posexplode("steps").alias("i", "s")).select(
        "length", F.col("s.*"), F.lead("s.first").over(Window.partitionBy("length").orderBy("i")).alias("next"))
    placed = ranked.join(F.broadcast(split), "length").where(
        (F.col("_rank") >= F.col("first")) & (F.col("next").isNull() | (F.col("_rank") < F.col("next"))))
    at = F.col("_rank") - F.col("first")
    return placed.select(*names, (F.col("sequence") + F.floor(at / F.col("each"))).alias("sequence_id"),
                         (F.col("offset") + at % F.col("each") * F.col("length")).alias("offset"))

"""Links between the tokens of two tokenizers over the same bytes.

Two tokenizations of one text cut it into groups: the stretches between byte
offsets at which a token of both ends. They are found by pointer jumping. A
token of B points to the token of A that holds its last byte, the farthest to
the right that it overlaps; a token of A points to such a token of B if that
reaches farther, else to itself. Successors of all tokens of a block are then
doubled (``p = p[p]``) until nothing moves: every token holds the terminal
token of its component, and that labels its group. The number of rounds is
the logarithm of the longest chain.

A corpus-wide count of linked id pairs follows. A task cuts its documents into
blocks of about ``STEP`` characters, and a block is one row of a written table:
its distinct groups, the links of those, its distinct id pairs with the number
of its documents that hold them linked, and each document as a list of groups.
Only distinct pairs of a block are shuffled: to be summed, to be marked where
their count is the highest of their A id (one row per id of A's vocabulary,
which bounds that table), and back to their block. A block of documents is
thus small whatever the corpus, and no pair is ever gathered with all places
where it occurs.

Defined cases: a null or empty text has no tokens, and so has one that either
tokenizer does not give back byte by byte; all its numbers are 0 and its text
of groups is empty (not hashed). A very long text is a block of its own. Rows
that repeat id and text are documents of their own and each counts. Equal
counts are all the highest. A null id stays null. An empty table gives no
rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import U64, mix, slices, text_of
from tidings.session import work_path

STEP = 4_000_000
# Links of one group that are listed one by one; beyond, its ids are reduced
# to distinct ones with their numbers first.
WIDE = 1 << 12
# How byte-level vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others follow from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids by a byte-level BPE file; special tokens are plain text. Where the
    file numbers its tokens in the order of its merges, ids are ranks, and the
    faster library reads them; else the file's own."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["content"] for t in model.get("added_tokens", ()) if t.get("special")}
        letters = byte_letters()
        vocab = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        self.lengths = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.lengths[i] = len(token)
        self.tokens = {i: token for token, i in vocab.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        made = [model["model"]["vocab"]["".join(m)] for m in merges]
        if made == sorted(made) and len(vocab) == 256 + len(made) and min(made, default=0) >= 256:
            import tiktoken
            ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
            self.encode, self.decode = ranks.encode_ordinary, ranks.decode_bytes
        else:
            from tokenizers import Tokenizer
            whole = Tokenizer.from_file(path)
            whole.encode_special_tokens = True
            self.encode = lambda text: whole.encode(text, add_special_tokens=False).ids
            self.decode = lambda ids: b"".join(map(self.tokens.__getitem__, ids))


class Pieces:
    """Ids by a sentence-piece file, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.tokens[i] = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode()
        self.lengths = np.array([len(self.tokens[i]) for i in range(len(self.tokens))], dtype=np.int64)
        self.encode = model.encode

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the terminal token (of A) of its
    component; ends are offsets that rise, and both last ones are equal."""
    n = len(end_a)
    over_b = np.searchsorted(end_b, end_a - 1, side="right")
    farther = end_b[over_b] > end_a
    successor = np.concatenate((np.where(farther, n + over_b, np.arange(n)), np.searchsorted(end_a, end_b - 1, side="right")))
    while True:
        twice = successor[successor]
        if np.array_equal(twice, successor):
            return successor[:n], successor[n:]
        successor = twice


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... of every i, counts[i] numbers each."""
    return np.repeat(first - _starts(counts), counts) + np.arange(counts.sum())


def kinds(ids_a, size_a, ids_b, size_b) -> tuple[np.ndarray, np.ndarray]:
    """Number of every group's kind and each kind's first group; groups are of
    one kind when their ids of A and of B are the same lists. Hashes find the
    kinds, and every group is compared with the first of its kind."""
    first_a, first_b = _starts(size_a), _starts(size_b)
    seed = 0
    while True:
        seed += 1
        at_a = (np.arange(len(ids_a)) - np.repeat(first_a, size_a)).astype(U64)
        at_b = (np.arange(len(ids_b)) - np.repeat(first_b, size_b)).astype(U64)
        salt = U64(seed << 40)
        code = np.add.reduceat(mix((ids_a.astype(U64) << U64(20)) + at_a + salt), first_a)
        code = mix(code) + np.add.reduceat(mix((ids_b.astype(U64) << U64(20)) + at_b + (salt << U64(1))), first_b)
        _, first, kind = np.unique(code, return_index=True, return_inverse=True)
        same = (size_a == size_a[first][kind]).all() and (size_b == size_b[first][kind]).all()
        if same and (ids_a == ids_a[_spread(first_a[first][kind], size_a)]).all() \
                and (ids_b == ids_b[_spread(first_b[first][kind], size_b)]).all():
            return kind, first


def links(a: list[np.ndarray], b: list[np.ndarray], most: int = WIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, pair, times): the links of every kind of group, by kind."""
    kind, pair, times = [], [], []
    wide = np.array([len(x) * len(y) > most for x, y in zip(a, b)], dtype=bool)
    flat = np.flatnonzero(~wide)
    if len(flat):
        size_a = np.array([len(a[i]) for i in flat])
        size_b = np.array([len(b[i]) for i in flat])
        all_a, all_b = np.concatenate([a[i] for i in flat]), np.concatenate([b[i] for i in flat])
        left = np.repeat(all_a.astype(np.int64), np.repeat(size_b, size_a))
        right = all_b[_spread(np.repeat(_starts(size_b), size_a), np.repeat(size_b, size_a))]
        of = np.repeat(flat, size_a * size_b)
        made = (left << 32) | right
        order = np.lexsort((made, of))
        of, made = of[order], made[order]
        fresh = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (made[1:] != made[:-1]))))
        kind.append(of[fresh]), pair.append(made[fresh]), times.append(np.diff(np.append(fresh, len(of))))
    for i in np.flatnonzero(wide):
        left, n_left = np.unique(a[i], return_counts=True)
        right, n_right = np.unique(b[i], return_counts=True)
        made = ((left.astype(np.int64) << 32)[:, None] | right[None, :]).ravel()
        kind.append(np.full(len(made), i)), pair.append(made), times.append(np.outer(n_left, n_right).ravel())
    if not kind:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    of = np.concatenate(kind)
    order = np.argsort(of, kind="stable")
    return of[order], np.concatenate(pair)[order], np.concatenate(times)[order]


def block(texts: list[str], coder_a: ByteLevel, coder_b: Pieces, most: int = WIDE) -> dict:
    """The row of a block, but for ids and its number."""
    ids_a, ids_b = [], []
    for text in texts:
        x, y, whole = np.zeros(0, np.int32), np.zeros(0, np.int32), (" " + text).encode()
        if text:
            found_a, found_b = coder_a.encode(" " + text), coder_b.encode(text)
            if coder_a.decode(found_a) == whole == coder_b.decode(found_b):
                x, y = np.fromiter(found_a, np.int32, len(found_a)), np.fromiter(found_b, np.int32, len(found_b))
        ids_a.append(x), ids_b.append(y)
    n_a = np.array([len(x) for x in ids_a], dtype=np.int64)
    n_b = np.array([len(x) for x in ids_b], dtype=np.int64)
    flat_a, flat_b = np.concatenate(ids_a), np.concatenate(ids_b)
    out = {"n_a": n_a, "n_b": n_b}
    if not len(flat_a):
        none = np.zeros(len(texts), np.int64)
        return out | {"n_groups": none, "n_links": none, "sha": [""] * len(texts), "sizes": none, "groups": none[:0], "many": none[:0],
                      "kind": none[:0], "pair": none[:0], "times": none[:0], "pairs": none[:0], "held": none[:0]}
    end_a, end_b = np.cumsum(coder_a.lengths[flat_a]), np.cumsum(coder_b.lengths[flat_b])
    last_a, last_b = terminals(end_a, end_b)
    # Terminals rise with the offset, so groups are numbered in order.
    size_a = np.diff(np.concatenate(([-1], np.flatnonzero(last_a == np.arange(len(flat_a))))))
    group_b = np.searchsorted(np.flatnonzero(last_a == np.arange(len(flat_a))), last_b)
    size_b = np.bincount(group_b, minlength=len(size_a))
    doc = np.repeat(np.arange(len(texts)), n_a)[np.cumsum(size_a) - 1]
    n_groups = np.bincount(doc, minlength=len(texts))
    n_links = np.bincount(doc, weights=size_a * size_b, minlength=len(texts)).astype(np.int64)
    kind, first = kinds(flat_a, size_a, flat_b, size_b)
    first_a, first_b = _starts(size_a), _starts(size_b)
    kind_a = [flat_a[i:i + n] for i, n in zip(first_a[first].tolist(), size_a[first].tolist())]
    kind_b = [flat_b[i:i + n] for i, n in zip(first_b[first].tolist(), size_b[first].tolist())]
    words = [",".join(map(str, x.tolist())) + "|" + ",".join(map(str, y.tolist())) for x, y in zip(kind_a, kind_b)]
    spelled, sha, at = list(map(words.__getitem__, kind.tolist())), [], 0
    for n in n_groups.tolist():
        sha.append(hashlib.sha256(";".join(spelled[at:at + n]).encode()).hexdigest() if n else "")
        at += n
    # Documents as distinct kinds of group with their numbers.
    held, many = np.unique(doc * len(first) + kind, return_counts=True)
    of_doc, group = held // len(first), held % len(first)
    link_kind, link_pair, times = links(kind_a, kind_b, most)
    pairs, link_pair = np.unique(link_pair, return_inverse=True)
    per_kind = np.bincount(link_kind, minlength=len(first))
    # In how many documents a pair is linked: each document's kinds, their
    # pairs, every pair once. A few documents at a time.
    first_link = _starts(per_kind)
    docs_with = np.zeros(len(pairs), dtype=np.int64)
    for lo, hi in slices(per_kind[group].tolist(), 4_000_000):
        lo = lo if lo == 0 else np.searchsorted(of_doc, of_doc[lo])  # start with a whole document
        hi = hi if hi == len(group) else np.searchsorted(of_doc, of_doc[hi])
        if lo < hi:
            counts = per_kind[group[lo:hi]]
            made = np.repeat(of_doc[lo:hi], counts) * len(pairs) + link_pair[_spread(first_link[group[lo:hi]], counts)]
            docs_with += np.bincount(np.unique(made) % len(pairs), minlength=len(pairs))
    return out | {"n_groups": n_groups, "n_links": n_links, "sha": sha, "sizes": np.bincount(of_doc, minlength=len(texts)), "groups": group,
                  "many": many, "kind": link_kind, "pair": link_pair, "times": times, "pairs": pairs, "held": docs_with}


BLOCK = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, "
         "sizes binary, groups binary, many binary, kind binary, pair binary, times binary, pairs array<long>, held array<long>")
_coders: dict[tuple[str, str], tuple] = {}


def _coded(path_a: str, path_b: str) -> tuple:
    if (path_a, path_b) not in _coders:
        _coders[path_a, path_b] = ByteLevel(path_a), Pieces(path_b)
    return _coders[path_a, path_b]


def _blocks(path_a: str, path_b: str, step: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder_a, coder_b = _coded(path_a, path_b)
        schema = pa.schema([("block", pa.int64()), *((n, pa.list_(pa.int64())) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
                            ("sha", pa.list_(pa.string())), *((n, pa.binary()) for n in ("sizes", "groups", "many", "kind", "pair", "times")),
                            *((n, pa.list_(pa.int64())) for n in ("pairs", "held"))])
        number = TaskContext.get().partitionId() << 33
        ids, texts, held = [], [], 0

        def done() -> pa.RecordBatch:
            row = block(texts, coder_a, coder_b, most) | {"block": number, "doc_id": ids}
            for name in ("sizes", "groups", "many", "kind", "pair", "times"):
                row[name] = row[name].astype("<u4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids.append(i), texts.append(text)
                held += len(text)
                if held >= step:
                    yield done()
                    ids, texts, held, number = [], [], 0, number + 1
        if texts:
            yield done()
    return run


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
           step: int = STEP, most: int = WIDE) -> DataFrame:
    """The written table of blocks. Both paths are files every executor can open."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    made = rows.mapInArrow(_blocks(path_a, path_b, step, most), BLOCK)
    path = work_path(docs.sparkSession, "token_blocks")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def pair_counts(table: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): in how many documents corpus-wide an id of A
    and one of B are linked, and whether no other count of that a is higher."""
    held = table.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("x.*")
    count = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("count"))
    count = count.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit(2**32 - 1))})
    highest = count.groupBy("a").agg(F.max("count").alias("highest"))
    return count.join(highest, "a").select("pair", "a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column[0].as_py(), dtype="<u4").astype(np.int64)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            of = {n: _numbers(row.column(n)) for n in ("sizes", "groups", "many", "kind", "pair", "times")}
            kinds_of = int(of["groups"].max(initial=-1)) + 1
            out = []
            for name in ("best", "count"):
                found = row.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                # Sums stay integers: counts of pairs by kind, then by document.
                each = np.zeros(kinds_of, dtype=np.int64)
                np.add.at(each, of["kind"], of["times"] * found[of["pair"]])
                whole = np.concatenate(([0], np.cumsum(of["many"] * each[of["groups"]])))
                ends = np.cumsum(of["sizes"])
                out.append(pa.array(whole[ends] - whole[ends - of["sizes"]], pa.int64()))
            yield pa.RecordBatch.from_arrays([*(row.column(n).flatten() for n in names), *out, row.column("sha").flatten()],
                                             names=[*names, "n_best", "count_sum", "groups_sha256"])


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
               step: int = STEP, most: int = WIDE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    table = blocks(docs, path_a, path_b, id_col, text_col, step, most)
    here = table.select("block", F.posexplode("pairs").alias("at", "pair"))
    found = (here.join(pair_counts(table), "pair").groupBy("block")
             .agg(F.array_sort(F.collect_list(F.struct("at", "count", F.col("best").cast("long").alias("best")))).alias("x")))
    found = found.select("block", F.col("x.count").alias("count"), F.col("x.best").alias("best"))
    none = F.array().cast("array<long>")
    rows = table.drop("pairs", "held").join(found, "block", "left").withColumns(
        {n: F.coalesce(n, none) for n in ("count", "best")})
    return rows.mapInArrow(_summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                    "groups_sha256 string")

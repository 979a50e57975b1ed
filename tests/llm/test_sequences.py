"""Runs, token links and benchmark passages against brute force, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import itertools
import random
import time
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from tests.llm.test_rows import ODD, clash, docs
from tidings.llm import decontamination, periodic_runs, token_links

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Runs.

def brute_runs(words):
    number, found = {}, {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    for q in range(1, len(words) // 4 + 1):
        step = np.diff(np.concatenate(([0], (ids[:-q] == ids[q:]).astype(int), [0])))
        for start, end in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if end - start + q >= max(6, 4 * q):
                found.setdefault((start, end - start + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_digest(doc_id, text, plant):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and n and h % 10 == 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def repeating(seed, many):
    draw = random.Random(seed)
    for i in range(many):
        letters, words = "abcde"[:draw.choice([1, 2, 3, 5])], []
        while len(words) < draw.randint(0, 250):
            words += [draw.choice(letters) for _ in range(draw.randint(1, 40))] * draw.choice([1, 1, 2, 4, 5, 9])
        yield i, " ".join(words)


RUNS = [(900, "a " * 3000), (901, " ".join(f"w{i % 300}" for i in range(4000))), (902, "x " * 5), (903, "x " * 6), (904, "a b " * 4),
        (905, "a b " * 3 + "a"), (906, "Ä ß ä " * 9), (907, "x\x0by\x1cz " * 8), (908, "c c c c c c b " * 5)]


@pytest.mark.parametrize("tile", [8192, 64])
def test_runs_equal_brute_force(spark, tile):
    rows = [*repeating(5, 150), *RUNS, *((r[0], r[1]) for r in ODD)]
    source = spark.createDataFrame(rows, SCHEMA)
    got = Counter(tuple(r) for r in periodic_runs.digest(periodic_runs.runs(source, tile=tile)).collect())
    assert got == Counter(brute_digest(d, t, False) for d, t in rows)


def test_runs_of_planted_repeats(spark):
    rows = [(i, " ".join(random.Random(i).choices("abcdefghij", k=i % 90))) for i in range(400)] + [(None, "a b c"), (7, None), (48, "")]
    source = spark.createDataFrame(rows, SCHEMA).withColumn("text", periodic_runs.planted())
    got = Counter(tuple(r) for r in periodic_runs.digest(periodic_runs.runs(source)).collect())
    assert got == Counter(brute_digest(d, t, True) for d, t in rows)
    assert sum(1 for r in got if r[1]) > 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 8))
def test_z_reach(words, s):
    for at in range(0, len(words), s):
        every = {}
        for q in range(s, 2 * s):
            if at + q < len(words):
                on = next((k for k in range(s) if at + q + k >= len(words) or words[at + k] != words[at + q + k]), s)
                back = next((k for k in range(s) if at - 1 - k < 0 or words[at - 1 - k] != words[at + q - 1 - k]), s)
                if on == s or back == s:
                    every[q] = (back, on)
        assert {q: (b, f) for q, b, f in periodic_runs.reach(words, at, s)} == every


# Token links.

def brute_groups(text, a, b, letters):
    if not text:
        return [], [], []
    found = a.encode(" " + text, add_special_tokens=False)
    ids_a, ids_b = found.ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in t) for t in found.tokens]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return [], [], []
    end_a, end_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
    groups, i, j = [], 0, 0
    for cut in sorted(set(end_a) & set(end_b)):
        x, y = [], []
        while i < len(end_a) and end_a[i] <= cut:
            x.append(ids_a[i])
            i += 1
        while j < len(end_b) and end_b[j] <= cut:
            y.append(ids_b[j])
            j += 1
        groups.append((x, y))
    return ids_a, ids_b, groups


def brute_alignment(rows):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters, count, each = token_links.byte_letters(), Counter(), []
    for doc_id, text in rows:
        ids_a, ids_b, groups = brute_groups(text, a, b, letters)
        linked = [(x, y) for left, right in groups for x in left for y in right]
        count.update(set(linked))
        each.append((doc_id, ids_a, ids_b, groups, linked))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    return Counter((d, len(x), len(y), len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k),
                    sha(";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)) if g else "")
                   for d, x, y, g, k in each)


def strange(seed, many):
    draw = random.Random(seed)
    parts = ["word", " ", "  ", "\n", "\t", "▁", "é", "日本語", "🙂", "<|endoftext|>", "<s>", "<0x41>", "12345", "don't", "===", " ",
             "​", "Ünï", "\x00", "\x1c", "ﬁ", "é", "--", "ab" * 30]
    for i in range(many):
        yield 1000 + i, "".join(draw.choices(parts, k=draw.randint(0, 40)))


@pytest.mark.parametrize("step, wide", [(4_000_000, 1 << 12), (500, 2)])
def test_token_links_equal_brute_force(spark, step, wide):
    rows = [*((r[0], r[1]) for r in ODD), *strange(4, 200), (70, "=" * 5000), (71, "a" * 4001), (72, "9" * 3333)]
    source = clash(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    got = Counter(tuple(r) for r in token_links.alignments(source, A, B, step=step, most=wide).collect())
    assert got == brute_alignment(rows)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_terminals_label_groups(a, b):
    end_a, end_b = (np.array(sorted(x | {61})) for x in (a, b))
    cuts = sorted(set(end_a.tolist()) & set(end_b.tolist()))
    want = lambda ends: [next(i for i, c in enumerate(cuts) if c >= e) for e in ends.tolist()]
    last_a, last_b = token_links.terminals(end_a, end_b)
    label = {t: i for i, t in enumerate(sorted(set(last_a.tolist())))}
    assert [label[t] for t in last_a.tolist()] == want(end_a) and [label[t] for t in last_b.tolist()] == want(end_b)
    assert [int(end_a[t]) for t in label] == cuts


# Benchmark passages.

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_hits(rows, items, width=10):
    wanted = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            wanted.setdefault(tuple(words[i:i + width]), set()).add(item)
    out = []
    for doc_id, text in rows:
        words, hit, found = plain_words(text), set(), set()
        for size in {len(w) for w in wanted}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in wanted:
                    hit.update(range(i, i + size))
                    found |= wanted[tuple(words[i:i + size])]
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(found)), bool(hit)))
    return Counter(out)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs away into the dark wood"), (2, "Short one"), (3, None), (4, "... !"),
         (5, "a a a a a a a a a a a a"), (None, "no id here"), (1, "second text of the first item"), (2, "Short one"), (12, "short ONE"),
         (6, "über straße naïve 数学 x1 y2 z3 eins zwei drei vier fünf")]


def passages():
    draw = random.Random(8)
    pool = [plain_words(t) for _, t in ITEMS if t and plain_words(t)]
    for i in range(150):
        words = []
        for _ in range(draw.randint(0, 6)):
            item = draw.choice(pool)
            cut = draw.randint(0, len(item))
            words += draw.choice([item, item[:cut], item[cut:], draw.choices("abcdefg", k=5)])
        yield i, draw.choice([" ", ", ", "\n-", "  "]).join(words)


@pytest.mark.parametrize("shard, long, block", [(1 << 19, 1 << 18, 50_000), (300, 40, 8)])
def test_passages_equal_brute_force(spark, shard, long, block):
    rows = [*passages(), *((r[0], r[1]) for r in ODD), (80, "a " * 500), (81, "A " * 9), (82, "x " * 300 + ITEMS[0][1] + " y" * 300)]
    source = clash(spark.createDataFrame(rows, SCHEMA))
    items = clash(spark.createDataFrame(ITEMS, "item_id long, text string"))
    found = decontamination.search(decontamination.build(source, shard_words=shard, long=long), decontamination.windows(items), most=block, walk=64)
    assert Counter(tuple(r) for r in decontamination.decisions(found).collect()) == brute_hits(rows, ITEMS)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZ09 \t\n\x00\x1c\x7f\x85\xa0\u2028\u3000"))))
def test_passage_words_are_those_of_the_pattern(text):
    assert decontamination.words_of(text) == decontamination.WORDS.findall(text.translate(decontamination.LOWER))


def test_passage_words_of_any_script_cost_alike():
    def cost(text):
        began = time.process_time()
        decontamination.words_of(text)
        return time.process_time() - began

    plain, other = "The Quick brown " * 50_000, "Thé Quick bröwn " * 50_000
    assert min(cost(other) for _ in range(5)) < 3 * min(cost(plain) for _ in range(5))


def test_passages_are_cut_from_texts(spark):
    rows = [(1, "Before. The QUICK brown fox jumps over the lazy dog and runs! After."), (2, "clean text"), (3, None), (3, None),
            (None, "say: short, one; twice short one.")]
    source = spark.createDataFrame(rows, SCHEMA).withColumn("items", F.lit("kept"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontamination.cleaned(source, decontamination.search(decontamination.build(source), decontamination.windows(items)))
    assert out.columns == source.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted(
        [(1, "Before. ! After."), (2, "clean text"), (3, ""), (3, ""), (0, "say: ; twice .")])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), min_size=1, max_size=6), st.lists(st.sampled_from("abcd"), min_size=1, max_size=6))
def test_index_finds_every_place(documents, window):
    row = decontamination.index(documents)
    searcher = decontamination.Searcher(row)
    lo, hi = searcher.ranges(np.array([[searcher.symbols.get(w, 0) for w in window]]))
    at = np.sort(searcher.locate(np.arange(lo[0], hi[0])))
    begin = np.cumsum([0] + [len(d) + 1 for d in documents])
    assert at.tolist() == sorted(b + i for b, d in zip(begin.tolist(), documents) for i in range(len(d) - len(window) + 1)
                                 if d[i:i + len(window)] == window)


def test_sequences_of_nothing(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert periodic_runs.digest(periodic_runs.runs(none)).collect() == []
    assert token_links.alignments(none, A, B).collect() == []
    found = decontamination.search(decontamination.build(none), decontamination.windows(items))
    assert decontamination.decisions(found).collect() == []
    some = docs(spark)
    found = decontamination.decisions(decontamination.search(decontamination.build(some), decontamination.windows(items)))
    assert {(r.n_hit, r.contaminated) for r in found.collect()} == {(0, False)} and found.count() == len(ODD)

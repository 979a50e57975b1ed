"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
names, for every operator and stage; results against brute force."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pyspark.sql import functions as F
from tidings.llm import (exact_dedup, language_id, mixing, near_dedup, neighbours, packing, quality, surrogates,
                         url_filter, warc)
from tidings.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD = [
    (1, None, "en", "s", 0), (2, "", None, None, None), (3, " \n\t ", "en", "s", 3), (4, "Same words here and there", "en", "s", 1),
    (5, "Same words here and there", "en", "t", 1), (6, "same words here and there", "fr", "t", 1), (7, LONG, "en", "s", 1),
    (8, LONG + " end", "en", "s", 1), (9, "... 12 !!", None, "s", 1), (None, "a text without id", "en", "s", 1),
    (None, "Same words here and there", None, None, None), (10, "mail a.b@c.example.org now", "de", "s", 1),
    (10, "mail a.b@c.example.org now", "de", "s", 1), (11, "two words", "en", "s", 1),
]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOC)


def clash(df):
    """The columns operators use inside, as columns of the input."""
    names = ["key", "digest", "class", "bands", "n", "label", "rate", "copies", "u", "v", "slots", "kept", "score", "id"]
    return df.withColumns({n: F.lit(7) for n in names})


LABELS = [(4, 1, 0), (5, 1, 0), (6, 0, 0), (7, 1, 0), (8, None, 1), (99, 1, 1), (None, 1, 1), (4, 0, 0)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def shingles(text, k):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows, k, percent):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: shingles(t, k) for i, t in rows}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (find(i), len(sets[i])) for i in root}


def family(seed=1, size=60):
    """A large group of edited copies, so that many pairs are near the bound."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(500)}" for _ in range(80)]
    out = []
    for i in range(size):
        words = list(base)
        for _ in range(draw.randrange(8)):
            words[draw.randrange(80)] = f"x{draw.randrange(300)}"
        out.append((i, " ".join(words)))
    return out + [(size + i, " ".join(f"q{draw.randrange(40)}" for _ in range(draw.randrange(5)))) for i in range(30)]


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(1000, i) for i in range(300, 400)] + [(5, 5), (None, 4)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert found == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_exact(spark):
    out = exact_dedup.decisions(clash(docs(spark))).collect()
    assert len(out) == len(ODD)
    for r in out:
        text = next(t for i, t, *_ in ODD if i == r.doc_id and hashlib.sha256((t or "").encode()).hexdigest() == r.text_sha256)
        same = [i for i, t, *_ in ODD if (t or "") == (text or "")]
        assert r.group_size == len(same) and r.keep_id == max((i for i in same if i is not None), default=None)
        assert r.kept == (r.doc_id == r.keep_id or len(same) == 1)
    kept = exact_dedup.survivors(clash(docs(spark)))
    assert kept.columns == clash(docs(spark)).columns
    assert sorted(t or "" for t, in kept.select("text").collect()) == sorted({t or "" for _, t, *_ in ODD})
    assert exact_dedup.survivors(docs(spark, [])).count() == 0 == exact_dedup.decisions(docs(spark, [])).count()


def test_exact_against_history(spark):
    old = docs(spark, [(100, "a", "en", "s", 1), (101, "a", "en", "s", 1), (102, "b", "en", "s", 1)])
    index = exact_dedup.build_index(exact_dedup.digests(old))
    new = docs(spark, [(1, "a", "en", "s", 1), (2, "c", "en", "s", 1), (3, "c", "en", "s", 1)])
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.decisions(new, index).collect()}
    assert found == {1: (101, False), 2: (3, False), 3: (3, True)}
    assert [r.doc_id for r in exact_dedup.survivors(new, index).collect()] == [3]


def test_seeds_are_bijections():
    draw = np.random.default_rng(5)
    a = [draw.integers(0, exact_dedup.PRIME, n) for n in (1, 2, 5, 9, 0)]
    b = [draw.integers(1, exact_dedup.PRIME, n) for n in (1, 2, 5, 9, 0)]
    for x, y, seed in zip(a, b, exact_dedup.find_seeds(a, b)):
        assert sorted((x + seed * y) % exact_dedup.PRIME % max(1, len(x))) == list(range(len(x)))
    equal = [np.array([3, 3])]
    assert exact_dedup.find_seeds(equal, equal, tries=10).tolist() == [-1]


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near(spark, k, percent):
    rows = family()
    out = near_dedup.decisions(spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in out} == brute_components(rows, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_odd_rows(spark):
    out = near_dedup.decisions(clash(docs(spark))).collect()
    assert len(out) == len(ODD)
    found = {}
    for r in out:
        found.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert found[1] == [(0, 1)] and found[2] == [(0, 2)] and found[3] == [(0, 3)]
    assert found[8][0][1] == found[7][0][1] == 7
    kept = near_dedup.survivors(clash(docs(spark)))
    ids = sorted(-1 if i is None else i for i, in kept.select("doc_id").collect())
    # Of the group "same words ..." the row without id ranks lowest and stays.
    assert kept.columns == clash(docs(spark)).columns and ids == [-1, 1, 2, 3, 7, 9, 10, 11]
    assert near_dedup.survivors(docs(spark, [])).count() == 0


def test_sketch_estimates_similarity():
    draw = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        common = draw.integers(0, 2**63, int(2000 * share)).astype(np.uint64)
        sets = [np.concatenate((common, draw.integers(0, 2**63, 2000 - len(common)).astype(np.uint64))) for _ in range(2)]
        a, b = near_dedup.sketches(sets, 400)
        exact = len(common) / (4000 - len(common))
        assert abs((a == b).mean() - exact) < 0.1
    tiny = near_dedup.sketches([np.array([5], dtype=np.uint64)], 96)
    assert (tiny != np.iinfo(np.uint64).max).all()


def test_bitmaps_never_differ_more_than_sets():
    draw = np.random.default_rng(4)
    for size in (1, 30, 400, 5000):
        common = draw.integers(0, 2**63, size).astype(np.uint64)
        a, b = (np.concatenate((common, draw.integers(0, 2**63, int(draw.integers(0, size + 1))).astype(np.uint64))) for _ in range(2))
        apart = sum(int(x).bit_count() for x in (near_dedup.bitmap(a) ^ near_dedup.bitmap(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
        assert not (near_dedup.bitmap(a) ^ near_dedup.bitmap(a[::-1])).any()
    assert not near_dedup.bitmap(np.zeros(0, dtype=np.uint64)).any()


def test_language(spark):
    base = {"en": "the house and the garden of this old town were quiet", "fr": "la maison et le jardin de cette vieille ville étaient calmes",
            "de": "das haus und der garten dieser alten stadt waren ruhig"}
    rows = [(i, base[la], la, "s", 1) for i, la in enumerate(list(base) * 20)]
    model = language_id.fit(docs(spark, rows + ODD[:2]))
    assert {la: model.predict([t])[0][0] for la, t in base.items()} == {la: la for la in base}
    out = language_id.predictions(clash(docs(spark)).drop("score").withColumn("score", F.lit(1)), model).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id for r in out if r.lang_pred == "und"} == {1, 2, 3, 9}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out if r.doc_id is not None)
    kept = language_id.accepted(clash(docs(spark)), model)
    assert kept.columns == clash(docs(spark)).columns and not {1, 2, 3, 9} & {r.doc_id for r in kept.collect()}
    empty = language_id.fit(docs(spark, []))
    assert language_id.predictions(docs(spark), empty).where("lang_pred <> 'und'").count() == 0
    assert language_id.predictions(docs(spark, []), model).count() == 0


def test_ngrams_stay_within_words_and_texts():
    h, owner = language_id.grams(["ab cd", None, "", "ab"])
    assert set(owner.tolist()) == {0, 3}
    # " ab", "ab ", " cd", "cd " of the first; four letters each with both blanks.
    assert (owner == 0).sum() == 6 and (owner == 3).sum() == 3


def brute_bins(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit)[1]] -= n
        else:
            rooms.append(size - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    draw = random.Random(4)
    for _ in range(60):
        size = draw.choice([7, 16, 100])
        lengths = [draw.randint(1, size) for _ in range(draw.randint(0, 200))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        bins = {}
        for n, first, last, sequence, per, offset in packing.plan(histogram, size):
            for r in range(first, last):
                bins.setdefault(sequence + (r - first) // per, []).append((offset + (r - first) % per * n, n))
        for places in bins.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
        assert sorted(size - sum(n for _, n in p) for p in bins.values()) == brute_bins(lengths, size)


def test_packing(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = packing.pack(packing.pieces(clash(docs(spark)), corpus_pipeline.TOKENIZER)).collect()
    want = []
    for i, text, *_ in ODD:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want += [(i, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    order = lambda rows: sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], *r[1:]))
    assert order([tuple(r[:5]) for r in out]) == order(want)
    for s in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack(packing.pieces(docs(spark, []), corpus_pipeline.TOKENIZER)).count() == 0


@pytest.mark.parametrize("text", ["It's 12,5% of THE %%% l'été'", "ΣΑΣ ς İstanbul ǅ", "éa ́b", "a\x1cb c", "<|endoftext|> x", "É!É ½ ª", ""])
def test_encoder_equals_tokenizer(text):
    encoder = packing.Encoder(corpus_pipeline.TOKENIZER)
    for _ in range(2):
        assert next(iter(encoder.encode([text]))).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_mixing(spark):
    draw = random.Random(3)
    words = [[f"{d}{i}" for i in range(50)] for d in "hlt"]
    rows = [(i, " ".join(draw.choices(words[i % 3], k=draw.randint(20, 80))), "en", "s", 1) for i in range(300)]
    marks = [(i, int(i % 3 == 0), int(i % 3 == 2)) for i in range(300)]
    out = mixing.rates(clash(docs(spark, rows)), labels(spark, marks)).toPandas()
    total = out.tokens.sum()
    for d, target in mixing.TARGETS.items():
        assert abs((out.tokens * out.rate * out[f"p_{d}"]).sum() / total - target) < 0.01
    assert (out.rate >= 0).all() and (abs(out[["p_high", "p_low", "p_toxic"]].sum(axis=1) - 1) < 1e-9).all()
    assert set(out.loc[out.doc_id % 3 == 2, "p_toxic"] > 0.5) == {True}
    mixed = mixing.mixed(clash(docs(spark, rows)), labels(spark, marks))
    assert mixed.columns == clash(docs(spark, rows)).columns and mixed.count() == out.copies.sum()


def test_mixing_odd_rows(spark):
    out = mixing.rates(clash(docs(spark)), labels(spark)).collect()
    assert len(out) == len(ODD) and all(r.rate >= 0 for r in out)
    assert {r.doc_id for r in out if r.tokens == 0} == {1, 2, 3}
    assert mixing.rates(docs(spark, []), labels(spark)).count() == 0
    assert mixing.rates(docs(spark), labels(spark, [])).count() == len(ODD)


def test_warc(spark):
    long = "é" * 60
    rows = [(5, "http://a/1", long), (3, "http://a/b c\n", long), (9, None, long), (None, "x", "<p>"), (1, "u", None), (2, "v", ""),
            (7, "w", "<p>"), (7, "w", "<p>"), (8, "z", "y\r\n\r\nz" * 5000)]
    pages = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    out = warc.round_trip(pages, roll_bytes=300, shard_bytes=1000).collect()
    assert all(r.intact for r in out)
    size = lambda h: len((h or "").encode())
    want = sorted((i or 0, size(h), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if h == long and i != 3 else "response",
                   3 if h == long and i != 3 else 0) for i, _, h in rows)
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in out) == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_is_the_same_on_every_run(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<p>{i % 7}</p>" * 40) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    a, b = (sorted(map(tuple, warc.write(p, str(tmp_path / n), roll_bytes=2000, shard_bytes=9000).collect()))
            for n, p in (("a", pages), ("b", pages.repartition(3))))
    assert a == b and len({r[1] for r in a}) > 1 and len(a) > len({r[1] for r in a})
    assert not list((tmp_path / "a/_temporary").iterdir())
    read = warc.read(spark.read.parquet(str(tmp_path / "a/_manifest")), str(tmp_path / "a"))
    assert read.where("record_type = 'response'").count() == 7


def test_warc_shards_hold_outlying_and_repeated_ids(spark, tmp_path):
    """An id far from the others, and one id that most rows repeat."""
    body = lambda i: f"<p>{i}</p>" * 30
    rows = [(i, f"http://a/{i}", body(i)) for i in range(300)] + [(2**62, "http://z", body(1))]
    rows += [(150, "http://a/150", body(150))] * 600 + [(None, f"http://n/{i}", body(i)) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    files = warc.write(pages, str(tmp_path / "a"), shard_bytes=20_000)
    total = sum(len(h) + 700 for *_, h in rows)
    shards = {r.shard: r.n for r in files.groupBy("shard").agg(F.sum("records").alias("n")).collect()}
    assert sum(shards.values()) == len(rows) and abs(len(shards) - total / 20_000) <= 2
    assert max(shards.values()) * 700 < 30_000
    found = warc.read(files, str(tmp_path / "a"), with_payload=False).collect()
    least = {}
    for i, _, h in rows:
        least[h] = min(least.get(h, 2**63), -1 if i is None else i)
    want = sorted((-1 if i is None else i, u, "response" if least[h] == (-1 if i is None else i) else "revisit") for i, u, h in rows)
    assert sorted((-1 if r.page_id is None else r.page_id, r.url, r.record_type) for r in found) == want
    assert all(r.intact for r in found)


def test_neighbours(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(700, 16)) + draw.normal(size=(8, 16))[np.arange(700) % 8] * 2
    x[100:200] = x[100]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(None, x[0].tolist(), 1), (5000, None, 1), (5001, [0.0] * 16, 1), (5002, [None] * 16, 1),
           (5003, [float("nan")] * 16, 1), (5004, [1.0], 1), (0, x[0].tolist(), 1), (5005, [], 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    out = neighbours.search(clash(frame), F.col("id") % 50 == 0).toPandas()
    f = x.astype(np.float32).astype(np.float64)
    unit = f / np.linalg.norm(f, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 700, 50):
        s = unit @ unit[q]
        got = out[out.query_id == q].sort_values("rank")
        assert got["rank"].tolist() == [1, 2, 3, 4, 5] and q not in set(got.vec_id)
        np.testing.assert_allclose(got.score, s[got.vec_id], atol=1e-9)
        kth = np.sort(np.delete(s, q))[-5]
        hits += (s[got.vec_id] >= kth - 1e-9).sum()
    assert hits / 70 >= 0.9
    same = out[out.query_id == 100].sort_values("rank")
    assert same.vec_id.tolist() == [101, 102, 103, 104, 105]
    few = neighbours.search(frame.where("vec_id in (0, 1, 2)"), F.col("id") % 50 == 0).orderBy("rank").collect()
    assert {r.vec_id for r in few} == {1, 2}
    assert neighbours.search(frame.limit(0), F.col("id") % 50 == 0).count() == 0
    assert neighbours.search(frame.where("vec_id = 0"), F.col("id") % 50 == 0).count() == 0


def test_surrogates(spark):
    key = b"k"
    rows = [(51, "write a.b@c.example.org or A.B@C.example.org", "en", "s", 1), (52, "a.b@c.example.org, 10.1.2.3 and 4111 1111 1111 1111", "en", "s", 1),
            (53, "Mr. John Smith met Frau Anna Smith. Mr. Smith left; +1 (017) 555-7713", "en", "s", 1)]
    out = {(r.doc_id, i): r for i, r in enumerate(surrogates.pseudonymise(clash(docs(spark, rows + ODD)), key).collect())}
    assert len(out) == len(rows) + len(ODD)
    texts = {r.doc_id: r.text for r in out.values()}
    mail = texts[10].split()[1]
    assert mail != "a.b@c.example.org" and mail in texts[51] and mail in texts[52] and texts[51].lower().count(mail) == 2
    for value in ("10.1.2.3", "4111 1111 1111 1111", "John", "Smith", "555-7713"):
        assert not any(value in (t or "") for t in texts.values())
    assert texts[51].split()[3] == mail[0].upper() + mail[1:2] + mail[2].upper() + mail[3:4] + mail[4].upper() + mail[5:]
    assert texts[7] == LONG and texts[4] == "Same words here and there"
    for r in out.values():
        assert (r.text is None) == (r.doc_id == 1)
        for e in r.entities:
            assert 0 <= e.start and e.start + e.length <= len(r.text)
    assert surrogates.pseudonymise(docs(spark, []), key).count() == 0


def test_surrogates_do_not_collide(spark):
    names = [(i, f"Mr. {a}{b}", "en", "s", 1) for i, (a, b) in enumerate(
        (a, b) for a in ("Kan", "Lor", "Mid", "Nuv") for b in "abcdefghijklmnopqrstuvwxyz")]
    names += [(1000 + i, f"Mr. {a}{b}{c}", "en", "s", 1) for i, (a, b, c) in enumerate(
        (a, b, c) for a in ("Rak", "Sol") for b in "abcdefghijklmnopqrstuvwxyz" for c in "abcdefghijklmnopqrstuvwxyz")]
    out = [r.text for r in surrogates.pseudonymise(docs(spark, names), b"k").collect()]
    assert len(set(out)) == len(names) and not set(out) & {n[1] for n in names}
    for kind, values in {"card": [f"{i:05d}" for i in range(100_000)], "ssn": [f"{i:05d}" for i in range(1000)]}.items():
        assert len({surrogates.surrogate(b"k", kind, v) for v in values}) == len(values)
    card = surrogates.surrogate(b"k", "card", "4111111111111111")
    assert surrogates.luhn(card) == 0 and len(card) == 16


def text_slots(text):
    out, before = [], None
    for chunk in text.split():
        out += [quality.slot(w) for w in quality.words(chunk)] + ([quality.slot(quality.AGAIN)] if chunk == before else [])
        before = chunk
    return out


def plain_vectors(texts):
    """Every word with every neighbour, one by one."""
    index, total = quality.index_vectors(), np.zeros((quality.SLOTS, quality.DIM))
    for n in map(text_slots, texts):
        for i, a in enumerate(n):
            for b in n[max(0, i - quality.WINDOW):i]:
                total[a] += index[b]
                total[b] += index[a]
    total -= total.sum(axis=0) / max(1.0, np.abs(total).sum()) * np.abs(total).sum(axis=1, keepdims=True)
    return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-6)


def test_language_counts_in_bounded_steps(monkeypatch):
    """N-grams of few characters at a time, and the same sums however many are held."""
    import pyarrow as pa
    draw, read, grams = random.Random(3), [], language_id.grams
    texts = ["".join(draw.choices("abcd ", k=40_000)) for _ in range(20)] + ["", "12"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 for i in range(22)], pa.int32())], names=["text", "l"])
    monkeypatch.setattr(language_id, "grams", lambda part: read.append(sum(map(len, part))) or grams(part))
    want = Counter()
    for i, text in enumerate(texts):
        want.update((i % 3, g) for g in grams([text])[0].view(np.int64).tolist())
    for held in (10, 500_000):
        monkeypatch.setattr(language_id, "HELD", held, raising=False)
        found = Counter()
        for b in language_id._count([batch]):
            for r in b.to_pylist():
                found[r["l"], r["g"]] += r["n"]
        assert found == want
    assert max(read) <= 250_000


def test_documents_go_to_workers_in_small_batches(spark):
    from tidings import session
    from tidings.llm import periodic_runs
    for made in (lambda: near_dedup.signatures(docs(spark), 3), lambda: periodic_runs.tiled(docs(spark)), lambda: language_id.fit(docs(spark, []))):
        spark.conf.set(session.BATCH_BYTES, "64m")
        made()
        assert spark.conf.get(session.BATCH_BYTES) == str(session.PAGE_BATCH)


def test_quality_words_of_all_texts(spark):
    """Vectors over more tasks than are added at once, with and without labels, are those of plain sums."""
    draw = random.Random(8)
    texts = ["", "one", "a a a", LONG] + [" ".join(draw.choices("Big big small 12 !! no. yes x_y".split(), k=9)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(quality.FAN + 9)
    assert np.allclose(quality.word_vectors(rows), plain_vectors(texts), atol=1e-5)
    assert not quality.word_vectors(rows.limit(0)).any()
    seen = quality.fit(docs(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]), labels(spark, [(5, 1, 0), (6, 0, 0)]))
    assert np.allclose(seen.vectors, plain_vectors(texts), atol=1e-5)


def test_quality_slots_of_a_chunk():
    for chunk in ("Big", "BIG", "B", "x1", "a_b", "…", "²", "Ⅷ", "ǅ", "9", "été!!", "ß.", "日本", "ʰ", "_", "1st-Rate"):
        assert quality.slots_of(chunk) == [quality.slot(w) for w in quality.words(chunk)]
        assert quality.words(chunk)[::2] == quality.WORD.findall(chunk)


def test_quality_slots_of_many_chunks():
    chunks = ["Big", "BIG", "B", "x1", "a_b", "…", "²", "Ⅷ", "ǅ", "9", "été!!", "ß.", "日本", "ʰ", "_", "1st-Rate", "small"]
    flat, size = quality.slots_in(chunks)
    assert flat.tolist() == [s for c in chunks for s in quality.slots_of(c)] and size.tolist() == [len(quality.slots_of(c)) for c in chunks]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10**6])
def test_quality_long_texts_in_parts(monkeypatch, size):
    """Texts cut anywhere give the sums of whole texts."""
    import pyarrow as pa
    texts = ["", "one", "a a a a b b", "", "No! no no 12 12 x_y", LONG[:2000]]
    made = {}
    monkeypatch.setattr(quality.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    for chunks in (size, 10**7):
        monkeypatch.setattr(quality, "CHUNKS", chunks)
        made[chunks] = list(quality._contexts([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    assert made[size] == made[10**7] and made[size][0].num_rows > 0


def test_quality(spark):
    draw = random.Random(6)
    good = [(i, " ".join(draw.choices("the of and house garden river town".split(), k=40)), "en", "s", 1) for i in range(60)]
    bad = [(100 + i, " ".join(draw.choices("BUY!! NOW!! | %%% $$$".split(), k=40)), "en", "s", 1) for i in range(60)]
    marks = [(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)]
    frame = docs(spark, good + bad)
    model = quality.fit(frame.where(~quality.held_out()), labels(spark, marks))
    out = quality.scores(clash(docs(spark, good + bad + ODD)), model).collect()
    assert len(out) == 120 + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    unseen = [r for r in out if r.held_out and r.doc_id is not None and (20 < r.doc_id < 60 or r.doc_id >= 100)]
    assert len(unseen) > 10 and all(r.predicted == (r.doc_id < 100) for r in unseen)
    assert quality.fit(docs(spark, []), labels(spark, marks)).scores(np.zeros((1, quality.DIM))).tolist() == [0.5]
    assert quality.fit(frame, labels(spark, [])).scores(np.zeros((1, quality.DIM))).tolist() == [0.5]
    assert quality.scores(docs(spark, []), model).count() == 0


def test_urls(spark):
    head = "<html><head><link rel='canonical' href='{}'></head>"
    rows = [(1, "http://A.example.org/es/1", None), (2, "https://x.net/a#f", head.format("http://a.example.org/es/1")),
            (3, "http://y.net/?q=1", "<META HTTP-EQUIV=refresh content=\"0; url=https://x.net/a\">"), (4, "no url", head.format("http://x.net/a")),
            (5, None, None), (6, "http://z.com/fr/9", head.format("https://x.net/a")), (7, "http://other.net/p", "<link rel=canonical href=q/>"),
            (8, "http://b.org", ""), (9, "http://w.net/", head.format("//v.org/ok")), (9, "http://w.net/", head.format("//v.org/ok")),
            (10, "http://example.org/en/12", None), (11, "http://notexample.org/es/", None)]
    pages = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    from tidings.llm.queries import RULES
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.rule_table(spark, RULES)).collect()}
    assert out[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    # Joined with an explicitly allowed page (6), the class without rules is allowed.
    assert out[6] == ("z.com", "/fr/9", "com/fr/", "allow") and out[2][2:] == (None, "allow") == out[3][2:]
    without = {r.page_id: r.verdict for r in url_filter.judge(pages.where("page_id <> 6"), url_filter.rule_table(spark, RULES)).collect()}
    assert without[2] == without[3] == "block" and without[9] == "allow" and without[7] == "allow"
    assert out[4] == out[5] == ("", "", None, "allow") and out[8] == ("b.org", "", None, "allow")
    assert out[10][2:] == ("example.org/en/1", "block") and out[11][2:] == ("org/", "allow")
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark, RULES)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage takes what its predecessor kept, odd rows included."""
    draw = random.Random(9)
    rows = ODD + [(100 + i, " ".join(draw.choices("the of and house garden river town in old".split(), k=30)), "en", "s", 1) for i in range(40)]
    rows += [(200 + i, rows[14][1], "en", "s", 1) for i in range(5)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, [(100 + i, i % 2, 0) for i in range(40)]).write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{i}"))
        before, now = now, spark.read.parquet(str(tmp_path / f"out{i}"))
        if name != "packing":
            assert now.columns == before.columns
        if name == "exact_dedup":
            assert now.count() == now.select("text").distinct().count() == before.select("text").distinct().count()
    assert now.count() >= before.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_quality_sums_by_size_and_by_entries():
    """Short rows are added in steps of equal size, bit for bit as one by one; index vectors by their few entries."""
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(50, quality.DIM)).astype(np.float32)
    size = np.array([0, 2, 1, 13, 8, 2, 3, 9, 0, 5, 4, 6, 7, 30])
    flat, at = draw.integers(0, 50, size=size.sum()), np.cumsum(size) - size
    want = np.zeros((len(size), quality.DIM), dtype=np.float32)
    want[size > 0] = np.add.reduceat(vectors[flat], at[size > 0])
    assert np.array_equal(quality.sums_of(vectors, flat, size), want)
    assert not quality.sums_of(vectors, flat[:0], np.zeros(3, dtype=np.int64)).any()
    index = quality.index_vectors()
    place, value = quality.entries(index)
    assert place.shape[1] <= quality.NONZERO
    again = np.zeros_like(index)
    np.put_along_axis(again, place, value.astype(np.float32), axis=1)
    assert np.array_equal(again, index)


def test_quality_pooler_adds_chunks_little_by_little():
    vectors = np.random.default_rng(6).normal(size=(quality.SLOTS, quality.DIM)).astype(np.float32)
    texts = [f"a{i} b{i % 7}, c{i // 3}" for i in range(50)]
    one, many = quality.Pooler(vectors), quality.Pooler(vectors)
    assert np.array_equal(one.means(texts), np.concatenate([many.means([t]) for t in texts]))
    assert many.sums.shape[1] < 2 * len(many.number) + 50

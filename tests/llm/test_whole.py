"""Inputs on which an operator once did less than the whole job."""

import random
from itertools import product

import numpy as np

from pyspark.sql import functions as F
from tests.llm.test_rows import brute_components, docs, family, labels
from tidings.llm import language_id, mixing, near_dedup, neighbours, surrogates, url_filter


def test_neighbours_in_a_group_of_near_copies(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=64)
    copies = base / np.linalg.norm(base) + draw.normal(size=(3000, 64)) * 0.001
    x = np.concatenate((copies, draw.normal(size=(300, 64)))).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = neighbours.search(frame, (F.col("id") % 50 == 0) & (F.col("id") < 3000)).toPandas()
    f = x.astype(np.float64)
    unit = f / np.linalg.norm(f, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        s = unit @ unit[q]
        s[q] = -2
        hits += len(set(np.argsort(-s)[:5]) & set(out[out.query_id == q].vec_id))
    print("recall", hits / 300)
    assert hits / 300 >= 0.9


def test_near_repeated_rows_in_mixed_buckets(spark):
    rows = family()
    many = [r for r in rows for _ in range(8)] + [(None, rows[5][1])] * 8 + [(None, "z " + rows[7][1])] * 8
    # Bands of one coordinate: buckets hold many classes that are not alike.
    out = near_dedup.decisions(spark.createDataFrame(many, "doc_id long, text string"), 3, 85, rows=1).collect()
    assert len(out) == len(many)
    # Null ids of two texts are two documents that rank below every id.
    want = brute_components(rows + [(-2, rows[5][1]), (-1, "z " + rows[7][1])], 3, 85)
    wrong = sum((r.component_id, r.n_shingles) != want[r.doc_id] for r in out if r.doc_id is not None and want[r.doc_id][0] >= 0)
    wrong += sum(r.component_id is not None for r in out if r.doc_id is None or want[r.doc_id][0] < 0)
    print("wrong rows", wrong, "of", len(out))
    assert wrong == 0


def test_mixing_of_domains_that_overlap(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    weight = [[1 + 0.5 * (i % 3 == d) for i in range(60)] for d in range(3)]
    share = [d for d, n in ((0, 170), (1, 170), (2, 20)) for _ in range(n)]
    rows = [(i, " ".join(draw.choices(words, weight[d], k=draw.randint(20, 80))), "en", "s", 1) for i, d in enumerate(share)]
    marks = [(i, int(d == 0), int(d == 2)) for i, d in enumerate(share)]
    out = mixing.rates(docs(spark, rows), labels(spark, marks)).toPandas()
    total = out.tokens.sum()
    off = [abs((out.tokens * out.rate * out[f"p_{d}"]).sum() / total - target) for d, target in mixing.TARGETS.items()]
    print("off by", max(off))
    assert max(off) < 1e-5 and (out.rate >= 0).all()


def test_posteriors_of_a_rare_domain_are_calibrated(spark):
    """On documents that the classifier was not fitted on, the mean posterior of
    each domain is near its share."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    weight = [[1 + 0.6 * (i % 3 == d) for i in range(300)] for d in range(3)]
    share = [d for d, n in ((0, 1400), (1, 1400), (2, 200)) for _ in range(n)]
    draw.shuffle(share)
    rows = [(i, " ".join(draw.choices(words, weight[d], k=draw.randint(20, 120))), "en", "s", 1) for i, d in enumerate(share)]
    marks = [(i, int(d == 0), int(d == 2)) for i, d in enumerate(share) if i < 2000]
    out = mixing.rates(docs(spark, rows), labels(spark, marks)).toPandas()
    held = out[out.doc_id >= 2000]
    off = [abs(held[f"p_{name}"].mean() - sum(share[i] == d for i in held.doc_id) / len(held)) for d, name in enumerate(mixing.DOMAINS)]
    print("off by", off)
    assert max(off) < 0.02


def test_mixing_that_cannot_meet_its_targets(spark):
    """The least squares' conditions hold where no rates meet the targets."""
    draw = np.random.default_rng(2)
    grid = mixing.GRID
    p = (draw.dirichlet((3, 6, 1), 300) * (0.5, 1, 0.3) * grid).astype(int)
    p[:, 1] = grid - p[:, 0] - p[:, 2]
    n = draw.integers(1, 100, 300)
    members = spark.createDataFrame([(x.tolist(), int(t)) for x, t in zip(p, n)], "_llm_p array<int>, _llm_tokens long")
    u = mixing.fit_rates(members)
    r = np.array([x[0] for x in members.withColumn("rate", mixing.rate(u)).select("rate").collect()])
    part, part_n = p / grid, n / n.sum()
    share = part_n @ part
    error = part.T @ (part_n * r) - [mixing.TARGETS[d] for d in mixing.DOMAINS]
    slope = part @ (error / share)
    assert abs(error).max() > 0.01 and slope.min() > -1e-4 and abs(slope[r > 0]).max() < 1e-4


def test_a_rare_language_is_learnt_from_a_large_table(spark):
    base = {"en": "the house and the garden of this old town were quiet", "fr": "la maison et le jardin de cette vieille ville étaient calmes",
            "el": "το σπίτι και ο κήπος της παλιάς πόλης ήταν ήσυχα", "ka": "სახლი და ბაღი ძველ ქალაქში მშვიდი იყო"}
    rows = [(i, base["en" if i % 2 else "fr"], "en" if i % 2 else "fr", "s", 1) for i in range(20_000)]
    rows += [(30_000 + i, base["el"], "el", "s", 1) for i in range(12)] + [(40_000 + i, base["ka"], "ka", "s", 1) for i in range(2)]
    model = language_id.fit(docs(spark, rows), fit_rows=300)
    assert {la: model.predict([t])[0][0] for la, t in base.items()} == {la: la for la in base}
    few = docs(spark, rows[-14:] + rows[:2])
    assert language_id.accepted(few, model).count() == 16
    assert language_id.quota([5, 10], 20) == float("inf") and language_id.quota([2, 12, 10_000, 10_000], 300) == 143


def test_more_names_than_names_of_three_syllables(spark):
    letters = "абвгдежзиклмнопр"
    names = [("family", "Щ" + "".join(x)) for x in product(letters, repeat=4)][:16_000]
    space = len(surrogates.SYLLABLES["cyrillic"]) ** 3 * len(surrogates.ENDINGS["cyrillic"])
    assert len(names) > space
    out = surrogates.resolve(spark.createDataFrame(names, "kind string, entity string"), b"k").collect()
    new = {r.surrogate for r in out}
    assert len(out) == len(new) == len(names) and not new & {n for _, n in names}


def test_names_stay_apart_and_their_parts_alike(spark):
    """More given names than the lists hold, so that many collide; every part
    has one surrogate wherever it stands, and no two names share one."""
    given = {"Mr": ["Adam", "Mark"] + [f"Jo{a}{b}" for a, b in product("aeiou", "lmnrst")],
             "Mrs": ["Eve"] + [f"Li{a}{b}" for a, b in product("aeiou", "lmnrst")]}
    family = ["Smith", "Wisorax", "Kakawix"] + [f"Ka{a}{b}" for a, b in product("aeiou", "lmnrstvwx")]
    names = [(t, g, f) for t in given for g in given[t] for f in family[:12]] + [(t, None, f) for t in given for f in family]
    rows = [(i, f"{t}. {f if g is None else f'{g} {f}'}", "en", "s", 1) for i, (t, g, f) in enumerate(names)]
    out = {r.doc_id: r.text.split(" ") for r in surrogates.pseudonymise(docs(spark, rows), b"k").collect()}
    part = {}
    for i, (t, g, f) in enumerate(names):
        title, *new = out[i]
        assert title == f"{t}." and len(new) == (1 if g is None else 2)
        assert part.setdefault(("family", f), new[-1]) == new[-1] and new[-1] not in family
        if g is not None:
            assert part.setdefault((t, g), new[0]) == new[0]
    families = [v for (k, _), v in part.items() if k == "family"]
    givens = [v for (k, _), v in part.items() if k != "family"]
    assert len(set(families)) == len(family) and len(set(givens)) == len(given["Mr"]) + len(given["Mrs"])


def test_a_redirect_from_outside_the_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.net/a", None), (2, "http://y.net/b", None)], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://bad.com/de/1", "http://x.net/a"), ("http://good.org/1", "http://y.net/b"),
                                       ("http://bad.com/de/2", "http://y.net/b")], "source string, target string")
    rules = url_filter.rule_table(spark, [url_filter.rule_of("com/de/", "block"), url_filter.rule_of("org/", "allow")])
    out = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules, redirects).collect()}
    assert out == {1: (None, "block"), 2: (None, "allow")}

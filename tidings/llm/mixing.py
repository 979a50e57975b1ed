"""Mixing documents to target domain weights by soft membership.

A classifier fitted on the label table gives every document a posterior over
domains. Nonnegative rates (how often a document is to be used) are then
fitted so that the expected tokens of each domain, sum of rate * tokens *
posterior, meet the targets: least squares of the relative errors and, of all
rates that reach it, those nearest to one. Such rates are max(0, 1 + u * posterior)
with one number u per domain: gradient steps from rates of one, projected on
nonnegative rates, only ever add multiples of the posteriors. The steps are
scaled by the curvature over the documents in use (a projected Newton method),
as plain ones need thousands where targets cannot be met; every step is one aggregate
over the documents' tokens and posteriors in Spark. The search ends when the optimality
condition holds, not after a number of steps, and an error is raised if it
cannot be made to hold. Posteriors are kept in millionths, so that domains
with a small share of every document count.

Everything is DataFrame functions: words are hashed to ``SLOTS``, and a text's
score is an aggregate over its words against a table of log likelihoods. The
classifier is fitted on at most about ``fit_rows`` labelled documents, drawn
by a hash of the id.

Defined cases: a null or blank text has no tokens and the prior's posterior; a
null label, or a label without a document, is ignored; several labels of one
document count as the largest; no labels at all: equal posteriors; targets
that cannot be met are met as nearly as rates allow; an empty table gives no
rows; other columns, whatever their names, are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.session import written

SLOTS = 4096
FIT_ROWS = 20_000
# Words after which further evidence is scaled down, as words are not independent.
TEMPER = 200
GRID = 1_000_000
# Distance from one is weighed this much against the targets' squared errors.
NEARNESS = (1e-2, 1e-4, 1e-6, 1e-8)
DOMAINS = ("high", "low", "toxic")
TARGETS = {"high": 0.75, "low": 0.17, "toxic": 0.08}
_P = "_llm_p"


def domain() -> Column:
    """A document's domain by its labels, as an index into DOMAINS."""
    return (F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0)
            .when(F.col("quality") == 0, 1))


def words(text_col: str) -> Column:
    """Slots of the lower-cased words of a text."""
    trimmed = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s+", " "))
    parts = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))
    return F.transform(parts, lambda w: F.pmod(F.xxhash64(w), F.lit(SLOTS)).cast("int"))


def _adder(table: Column) -> Callable[[Column, Column], Column]:
    return lambda total, slot: total + F.get(table, slot)


class Classifier:
    """Log priors and, per slot, log likelihood of each domain against the first."""

    def __init__(self, prior: list[float], ratio: np.ndarray):
        self.prior, self.ratio = prior, ratio

    def add_posterior(self, df: DataFrame, slots: str) -> DataFrame:
        """``df`` with millionths per domain, adding up to GRID, in _llm_p. Each
        step is bound to a column, so that no text is scored twice."""
        later = range(1, len(DOMAINS))
        sums = {}
        for k in later:
            # Thousandths as text: a short literal that the optimizer folds once.
            table = F.split(F.lit(",".join(str(int(round(x * 1000))) for x in self.ratio[k])), ",").cast("array<int>")
            sums[f"_llm_s{k}"] = F.aggregate(slots, F.lit(0).cast("long"), _adder(table))
        tempered = 1000 * (1 + F.size(slots) / TEMPER)
        scores = [F.lit(float(self.prior[0])), *[F.col(f"_llm_s{k}") / tempered + float(self.prior[k]) for k in later]]
        out = df.withColumns(sums).withColumns({f"_llm_z{k}": z for k, z in enumerate(scores)})
        names = [f"_llm_z{k}" for k in range(len(DOMAINS))]
        out = out.withColumn("_llm_top", F.greatest(*names))
        out = out.withColumns({z: F.exp(F.col(z) - F.col("_llm_top")) for z in names})
        out = out.withColumn("_llm_top", sum((F.col(z) for z in names[1:]), F.col(names[0])))
        out = out.withColumns({z: F.floor(F.col(z) / F.col("_llm_top") * GRID + 0.5).cast("int") for z in names[1:]})
        # Rounding is settled in the first domain.
        rest = sum((F.col(z) for z in names[2:]), F.col(names[1]))
        return out.withColumn(_P, F.array(GRID - rest, *names[1:])).drop("_llm_top", *sums, *names)


def fit_classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
                   id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Naive Bayes over hashed words of labelled documents."""
    named = labels.select(F.col("doc_id").alias("id"), domain().alias("d")).where("d is not null and id is not null")
    named = named.groupBy("id").agg(F.max("d").alias("d"))
    count = named.count()
    share = min(1.0, fit_rows / count) if count else 0.0
    drawn = lambda c: F.pmod(F.xxhash64(F.lit("mixing"), c), F.lit(1_000_000)) < share * 1_000_000
    texts = docs.select(F.col(id_col).cast("long").alias("id"), words(text_col).alias("slots")).where(drawn("id"))
    found = texts.join(named.where(drawn("id")), "id")
    # At most one row per domain and slot, and one per domain.
    counts = found.select("d", F.explode("slots").alias("slot")).groupBy("d", "slot").count().collect()
    docs_of = dict(found.groupBy("d").count().collect())
    seen = np.zeros((len(DOMAINS), SLOTS))
    for d, slot, n in counts:
        seen[d, slot] += n
    # How much oftener a domain has a word than all domains together. Both
    # sides are smoothed by one word, so that a domain with few documents is
    # not marked down for words that it could hardly have shown.
    usual = seen.sum(axis=1, keepdims=True) * seen.sum(axis=0) / max(seen.sum(), 1)
    likelihood = np.log((seen + 1) / (usual + 1))
    total = sum(docs_of.values()) + len(DOMAINS)
    prior = [log((docs_of.get(k, 0) + 1) / total) for k in range(len(DOMAINS))]
    return Classifier(prior, likelihood - likelihood[0])


def with_posteriors(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``docs`` with their tokens (words) and posterior in hidden columns."""
    slotted = docs.withColumn("_llm_slots", words(text_col)).withColumn("_llm_tokens", F.size("_llm_slots").cast("long"))
    return model.add_posterior(slotted, "_llm_slots").drop("_llm_slots")


def rate(u: np.ndarray) -> Column:
    """The rate of a document by its posterior."""
    return F.greatest(F.lit(0.0), F.lit(1.0) + sum((F.get(_P, F.lit(i)) * F.lit(float(x) / GRID) for i, x in enumerate(u)), F.lit(0.0)))


def fit_rates(members: DataFrame, targets: dict[str, float] = TARGETS, tolerance: float = 1e-7) -> np.ndarray:
    """The number of each domain that ``rate`` takes, for ``members`` (_llm_p,
    _llm_tokens). ``tolerance`` bounds how far the optimality condition may be
    off, as a part of all tokens; ValueError if that is not reached."""
    k = range(len(DOMAINS))
    p = [F.get(_P, F.lit(i)) / GRID for i in k]
    n = F.col("_llm_tokens").cast("double")
    sums = members.agg(F.sum(n), *[F.sum(n * x) for x in p]).first()
    tokens = sums[0] or 0.0
    u = np.zeros(len(DOMAINS))
    if not tokens:
        return u
    weight = np.array([targets[d] for d in DOMAINS])
    want = weight / weight.sum()
    # Errors count relative to a domain's share of the tokens at the start.
    share = np.maximum(np.array(sums[1:], dtype=float) / tokens, 1e-6)

    def at(u: np.ndarray, near: float) -> tuple[float, np.ndarray, np.ndarray]:
        """The dual problem's value, gradient and curvature."""
        r = rate(u)
        used = F.when(r > 0, n)
        row = members.agg(F.sum(n * r * r), *[F.sum(n * r * x) for x in p],
                          *[F.sum(used * p[i] * p[j]) for i in k for j in k]).first()
        got = np.array([x or 0.0 for x in row], dtype=float) / tokens
        return (got[0] / 2 - u @ want + near * (share * u * u).sum() / 2, got[1:1 + len(k)] - want + near * share * u,
                got[1 + len(k):].reshape(len(k), -1) + near * np.diag(share))

    for near in NEARNESS:
        value, slope, curve = at(u, near)
        while abs(slope).max() > tolerance:
            move, length = -np.linalg.solve(curve, slope), 1.0
            while True:
                tried = at(u + length * move, near)
                # Near the end the value no longer tells, but the slope does.
                if tried[0] <= value + 1e-4 * length * (slope @ move) or abs(tried[1]).max() < abs(slope).max() / 2:
                    break
                length /= 2
                if length < 1e-12:
                    raise ValueError(f"the rates' optimality condition is off by {abs(slope).max():.1e} of all tokens")
            u, (value, slope, curve) = u + length * move, tried
    return u


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
          id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, tokens, a posterior per domain, rate and copies of every document."""
    model = fit_classifier(docs, labels, id_col=id_col, text_col=text_col, **options)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    members = written(with_posteriors(narrow, model).drop("text"), "posteriors")
    out = members.withColumn("_llm_rate", rate(fit_rates(members, targets)))
    return out.select("doc_id", F.col("_llm_tokens").alias("tokens"),
                      *[(F.get(_P, F.lit(i)) / GRID).alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
                      F.col("_llm_rate").alias("rate"), copies("doc_id").alias("copies"))


def copies(id_col: str) -> Column:
    """Whole uses of a document: the rate, rounded by a hash of the id so that
    the expected number of uses is the rate."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), id_col), F.lit(1_000_000)) / 1_000_000
    return F.floor(F.col("_llm_rate") + draw).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
          id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, each as often as its copies say, with all their columns."""
    names = docs.columns
    model = fit_classifier(docs, labels, id_col=id_col, text_col=text_col, **options)
    members = written(with_posteriors(docs.select(F.col(text_col).alias("text")), model).drop("text"), "posteriors")
    rated = with_posteriors(docs, model, text_col).withColumn("_llm_rate", rate(fit_rates(members, targets)))
    often = rated.withColumn("_llm_copies", F.explode(F.array_repeat(F.lit(1), copies(id_col))))
    return often.select(names)

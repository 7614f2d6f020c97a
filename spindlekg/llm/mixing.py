"""Mixing to target weights by soft domain membership, in DataFrame and SQL functions alone.

A naive Bayes classifier over hashed words, counted by Spark on a bounded sample of the labelled table, gives every
document a probability of each domain. Every document then gets a rate, zero or more: how often it should be read. The
rates minimise the squared distance between the expected tokens of each domain (tokens x rate x probability, summed
over all documents) and the target totals, by projected gradient descent. Distances are weighted by the inverse of
G = sum(tokens x p x p'), and a step for a document is divided by its tokens, so that a step of one is the largest
that is safe and a problem without bounds is solved in one; with bounds, momentum speeds the rest. Only a vector and a matrix of the domains' number reach the
driver; each step is one aggregation over (tokens, probabilities, rate) columns, which are cut into a table in the
shared folder every few steps.

Edges, all tested: null and blank texts have no tokens and the domains' shares as probabilities; unlabelled rows, rows
with a null label and repeated labels (the largest counts) are fine; with no labels there is one domain, "all"; targets
of domains that no label has are spread over the rest; repeated rows are weighed each; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hash_share, materialize

BUCKETS = 4_096
#: How alike the words of one text are in what they tell of its domain, as a correlation. A naive sum over n words that
#: depend on each other is far too sure: it counts as that of n / (1 + (n - 1) c) independent ones, by one rule for texts of
#: any length. 0 adds up every word's.
DEPENDENCE = 1 / 256
ONLY = "all"


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    log_shares: np.ndarray
    log_odds: np.ndarray  # (domain, bucket), against the first domain


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"\s+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(BUCKETS))


def fit(docs: DataFrame, labels: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 8_000, smoothing: float = 20_000.0) -> DomainModel:
    """labels: id_col and what `domain` reads (null: unlabelled). About sample_rows labelled documents, whole, chosen by
    a hash of the id, are counted; shares are over all labels. smoothing: words that each domain is lent, dealt as over all
    domains together, so that a bucket only tells domains apart on good evidence."""
    known = labels.select(F.col(id_col).alias("i"), domain.cast("string").alias("domain")).where("i is not null and domain is not null").groupBy("i").agg(F.max("domain").alias("domain"))
    shares = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    names = tuple(sorted(shares))
    if not names:
        return DomainModel((ONLY,), np.zeros(1), np.zeros((1, BUCKETS)))
    total = sum(shares.values())
    sample = known.where(hash_share(F.col("i"), 23) < sample_rows / total)
    # the sample has sample_rows rows by expectation, whatever the size of the tables, so it can be broadcast
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(sample), "i")
    counted = rows.select("domain", F.explode(F.transform(words(F.col("t")), _bucket)).alias("b")).groupBy("domain", "b").agg(F.count("*").alias("n")).collect()
    counts = np.zeros((len(names), BUCKETS))
    for r in counted:
        counts[names.index(r["domain"]), r["b"]] += r["n"]
    everywhere = counts.sum(axis=0) + 0.5
    counts += smoothing * everywhere / everywhere.sum()
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    return DomainModel(names, np.log(np.array([shares[n] / total for n in names])), logs - logs[:1])


def _adder(odds: Column):
    return lambda total, bucket: total + F.get(odds, bucket)


def with_posteriors(docs: DataFrame, model: DomainModel, text: Column, tokens: str = "__tokens", posterior: str = "__p", dependence: float = DEPENDENCE) -> DataFrame:
    """docs with two more columns: the number of words, and an array of each domain's probability. No shuffle. The two
    names must be new; every column of docs stays. dependence: see DEPENDENCE."""
    if {tokens.lower(), posterior.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {tokens} or {posterior}")
    buckets, powers = fresh(docs, "__buckets", "__powers")
    table = lambda row: F.split(F.lit(",".join(f"{x:.5f}" for x in row)), ",").cast("array<double>")  # noqa: E731  folded to a constant
    found = docs.withColumn(buckets, F.transform(words(text), _bucket)).withColumn(tokens, F.size(buckets).cast("long"))
    calm = F.lit(1.0) / (F.lit(1.0) + F.lit(float(dependence)) * (F.greatest(F.col(tokens), F.lit(1)) - 1))
    scores = [F.lit(float(model.log_shares[0]))]
    for share, row in zip(model.log_shares[1:], model.log_odds[1:], strict=True):
        scores.append(F.lit(float(share)) + calm * F.aggregate(buckets, F.lit(0.0), _adder(table(row))))
    found = found.withColumn(powers, F.array(*scores)).drop(buckets)
    found = found.withColumn(powers, F.transform(powers, lambda s: F.exp(s - F.array_max(powers))))
    return found.withColumn(posterior, F.transform(powers, lambda s: s / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))).drop(powers)


def target_totals(model: DomainModel, weights: Mapping[str, float], budget: float) -> np.ndarray:
    """Tokens wanted of each domain: the budget dealt by the weights of the domains there are."""
    w = np.array([max(0.0, weights.get(d, 0.0)) for d in model.domains])
    w = w if w.sum() > 0 else np.ones(len(w))
    return budget * w / w.sum()


def rate(moves: Sequence[np.ndarray]) -> Column:
    """The rate of a row with __p after these steps (momentum, then a gradient by domain) from one."""
    if not moves:
        return F.lit(1.0)
    listed = F.array(*[F.array(*[F.lit(float(x)) for x in move]) for move in moves])
    gain = lambda move: F.aggregate(F.zip_with("__p", F.slice(move, 2, move_size), lambda p, m: p * m), F.lit(0.0), lambda a, x: a + x)
    move_size = len(moves[0]) - 1
    start = F.struct(F.lit(1.0).alias("now"), F.lit(1.0).alias("last"))
    step = lambda s, move: F.struct(F.greatest(F.lit(0.0), s["now"] + move[0] * (s["now"] - s["last"]) - gain(move)).alias("now"), s["now"].alias("last"))
    return F.aggregate(listed, start, step, lambda s: s["now"])


def fit_rates(weighed: DataFrame, model: DomainModel, weights: Mapping[str, float], budget: float | None = None, steps: int = 60, tolerance: float = 1e-4, cut_every: int = 8) -> list[np.ndarray]:
    """weighed: a table with __tokens and __p (see with_posteriors). Returns the steps that `rate` takes.

    A row's rate depends on its probabilities and the steps alone, so it can be had on any table with posteriors, and
    only tokens, probabilities and rates are ever cut into a table here. Steps carry momentum, which is dropped whenever
    the distance grows. budget: tokens in all; by default as many as there are. Stops when every domain is within
    tolerance of the budget of its target; targets that no rates meet are approached for all the steps.
    """
    k = len(model.domains)
    p = [F.col("__p")[d] for d in range(k)]
    n = F.col("__tokens").cast("double")
    row = weighed.agg(F.sum(n).alias("n"), *[F.sum(n * p[a] * p[b]).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k)]).first()
    budget = budget if budget is not None else float(row["n"] or 0)
    gram = np.array([[row[f"g{min(a, b)}_{max(a, b)}"] or 0.0 for b in range(k)] for a in range(k)])
    inverse = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    target = target_totals(model, weights, budget)
    rows = weighed.select("__tokens", "__p", F.lit(1.0).alias("__now"), F.lit(1.0).alias("__last"))
    now, last, moves = F.col("__now"), F.col("__last"), []
    before, nearest, age = None, np.inf, 1.0
    if budget <= 0:
        return moves
    for step in range(steps):
        sums = rows.agg(*[F.sum(n * p[d] * now).alias(f"c{d}") for d in range(k)]).first()
        gap = np.array([sums[f"c{d}"] or 0.0 for d in range(k)]) - target
        if np.abs(gap).max() <= tolerance * budget:
            break
        distance = float(gap @ inverse @ gap)
        if distance > nearest:
            age = 1.0
        nearest, older = distance, age
        age = (1 + np.sqrt(1 + 4 * age * age)) / 2
        momentum = (older - 1) / age if before is not None else 0.0
        ahead = gap if before is None else gap + momentum * (gap - before)
        before, gradient = gap, inverse @ ahead
        moves.append(np.concatenate(([momentum], gradient)))
        further = now + F.lit(momentum) * (now - last) - sum((p[d] * float(gradient[d]) for d in range(1, k)), p[0] * float(gradient[0]))
        rows = rows.select("__tokens", "__p", F.greatest(F.lit(0.0), further).alias("__now"), now.alias("__last"))
        if (step + 1) % cut_every == 0:
            rows = materialize(rows)
        now, last = F.col("__now"), F.col("__last")
    return moves


def copies(rate: Column, key: Column) -> Column:
    """A whole number whose mean over keys is the rate, and that only depends on both."""
    return (F.floor(rate) + (hash_share(key, 29) < rate - F.floor(rate)).cast("long")).cast("long")
